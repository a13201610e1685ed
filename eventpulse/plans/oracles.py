"""Independent SQL for the catalogue's queries, run by DuckDB on the same tables."""

FACT = """event_id, event_type, event_created_at, actor_id, actor_login, repo_id, repo_name,
  kafka_partition, kafka_offset, kafka_timestamp"""

G = """WITH g AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, ts AS event_created_at,
         user_id AS actor_id, 'user' || CAST(user_id AS VARCHAR) AS actor_login,
         k AS repo_id,
         CASE WHEN k % 10 = 0 THEN NULL
              WHEN k % 10 = 1 THEN 'solo' || CAST(k AS VARCHAR)
              WHEN k % 10 = 2 THEN 'org' || CAST(k % 7 AS VARCHAR) || '/repo' || CAST(k AS VARCHAR) || '/x'
              ELSE 'org' || CAST(k % 7 AS VARCHAR) || '/repo' || CAST(k AS VARCHAR) END AS repo_name,
         0 AS kafka_partition, event_id AS kafka_offset, ts AS kafka_timestamp, event_id AS n
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

STATUS = """CASE WHEN n % 97 = 0 THEN 'malformed' WHEN n % 89 = 0 THEN 'missing_required'
  WHEN n % 83 = 0 THEN 'bad_timestamp' ELSE 'ok' END AS status"""

RED = f"""{G}, red AS (
  SELECT *, {STATUS} FROM g
  UNION ALL
  SELECT * REPLACE (1 AS kafka_partition), {STATUS} FROM g WHERE n % 10 = 0
)"""

METRICS = f"""{RED}, m AS (
  SELECT count(*) AS fetched,
         count(*) FILTER (WHERE status IN ('malformed', 'missing_required')) AS invalid,
         count(*) FILTER (WHERE status = 'null_required') AS errors,
         count(*) FILTER (WHERE status IN ('ok', 'bad_timestamp')) AS passed,
         count(DISTINCT event_id) FILTER (WHERE status IN ('ok', 'bad_timestamp')) AS published
  FROM red)"""

OWNER = "string_split(repo_name, '/')[1]"
FIRST = f"{G} SELECT {FACT} FROM (SELECT *, {STATUS} FROM g) WHERE status = 'ok'"
REPO_ACTIVITY = f"{G} SELECT repo_name, count(*) AS event_count FROM g GROUP BY repo_name"
MINUTES = f"""{G} SELECT date_trunc('minute', event_created_at) AS minute, count(*) AS event_count
  FROM g GROUP BY 1"""
REPOS = f"""{G} SELECT repo_id, arg_max(repo_name, kafka_offset) AS repo_name,
  'https://example.org/' || CAST(repo_id AS VARCHAR) AS repo_url,
  max(event_created_at) AS last_updated FROM g GROUP BY repo_id"""
ACTORS = f"{G} SELECT actor_id, arg_max(actor_login, kafka_offset) AS login FROM g GROUP BY actor_id"


KEYS = [
    ("fact", "event_id", "red"),
    ("minute", "minute", "(SELECT DISTINCT date_trunc('minute', event_created_at) AS minute FROM g)"),
    ("types", "event_type", "(SELECT DISTINCT event_type FROM g)"),
    ("repo_activity", "repo_name", "(SELECT DISTINCT repo_name FROM g)"),
    ("actor_activity", "actor_login", "(SELECT DISTINCT actor_login FROM g)"),
    ("repos", "repo_id", "(SELECT DISTINCT repo_id FROM g)"),
    ("actors", "actor_id", "(SELECT DISTINCT actor_id FROM g)"),
    ("events", "event_id", "g"),
]


def _key_check(table: str, key: str, rows: str) -> str:
    return f"""SELECT '{table}' AS table_name,
      (SELECT count(*) FROM (SELECT {key} FROM {rows} WHERE {key} IS NOT NULL
        GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys,
      (SELECT count(*) FROM {rows} WHERE {key} IS NULL) AS null_keys"""


def _top(key: str) -> str:
    return f"""{G} SELECT {key}, count(*) AS event_count FROM g WHERE {key} IS NOT NULL
      GROUP BY {key} ORDER BY event_count DESC, {key} LIMIT 10"""


ORACLES = {
    "fact_projection": f"{G} SELECT {FACT} FROM g",
    "parse_flatten": f"{RED} SELECT {FACT} FROM red WHERE status = 'ok'",
    "record_status_counts": f"{RED} SELECT status, count(*) AS record_count FROM red GROUP BY status",
    "quarantine_rows": f"""{RED} SELECT status, kafka_offset, kafka_timestamp,
      CASE WHEN status <> 'malformed' THEN event_id END AS event_id FROM red WHERE status <> 'ok'""",
    "landed_responses": f"""{RED}, pages AS (
      SELECT *, kafka_offset // 100 % 10 = 7 AS broken FROM red WHERE status <> 'malformed')
      SELECT 'malformed' AS status, count(DISTINCT (kafka_partition, kafka_offset // 100)) AS record_count FROM pages
      WHERE broken GROUP BY 1
      UNION ALL
      SELECT status, count(*) AS record_count FROM pages WHERE NOT broken GROUP BY status""",
    "landed_array": f"{RED} SELECT status, count(*) AS record_count FROM red GROUP BY status",
    "canonical_event": f"""{G} SELECT event_id AS key, event_id AS id, event_type AS type,
      CASE WHEN n % 79 <> 0 THEN CAST(actor_id AS VARCHAR) END AS actor_id, actor_login,
      CASE WHEN n % 73 <> 0 THEN CAST(repo_id AS VARCHAR) END AS repo_id, repo_name,
      'https://example.org/' || CAST(repo_id AS VARCHAR) AS repo_url,
      strftime(event_created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
      CASE n % 4 WHEN 0 THEN '{{}}' WHEN 2 THEN '{{"k":' || CAST(repo_id AS VARCHAR) || '}}'
        WHEN 3 THEN CAST(repo_id AS VARCHAR) END AS payload,
      CASE n % 3 WHEN 0 THEN 'true' WHEN 2 THEN 'false' END AS public,
      CASE n % 5 WHEN 3 THEN '{{"id":' || CAST(repo_id AS VARCHAR) || '}}' WHEN 4 THEN '{{"id":null}}' END AS org
      FROM g""",
    "type_violations": f"""{G} SELECT event_id, kafka_offset, 'actor.id' AS leaf FROM g WHERE n % 79 = 0
      UNION ALL SELECT event_id, kafka_offset, 'repo.id' AS leaf FROM g WHERE n % 73 = 0""",
    "dedup_first_wins": FIRST,
    "ingest_metrics": f"""{METRICS} SELECT fetched, invalid, errors, passed - published AS duplicates, published
      FROM m""",
    "duplicate_rate": f"""{METRICS} SELECT CASE WHEN passed = 0 THEN 0.0
      ELSE CAST(passed - published AS DOUBLE) / CAST(passed AS DOUBLE) END AS duplicate_rate FROM m""",
    "events_per_minute": f"{MINUTES} ORDER BY 1",
    "event_type_distribution": f"""{G} SELECT event_type, count(*) AS event_count FROM g
      GROUP BY event_type ORDER BY event_count DESC, event_type""",
    "repo_activity": REPO_ACTIVITY,
    "actor_activity": f"""{G} SELECT actor_login, count(*) AS event_count,
      TIMESTAMP '2024-02-01 00:00:00' AS last_updated FROM g GROUP BY actor_login""",
    "owner_activity": f"{G} SELECT {OWNER} AS repo_owner, count(*) AS event_count FROM g GROUP BY 1",
    "top10_repos": _top("repo_name"),
    "top10_actors": _top("actor_login"),
    "repo_enriched": f"""{G} SELECT event_id, repo_name, {OWNER} AS repo_owner,
      string_split(repo_name, '/')[2] AS repo_short_name FROM g""",
    "dim_repos": REPOS,
    "dim_actors": ACTORS,
    "dim_repos_upsert": REPOS,
    "dim_upserts": REPOS,
    "events_normalized": f"""{G} SELECT event_id, event_type, repo_id, actor_id,
      event_created_at AS created_at, repo_id AS payload_k FROM g""",
    "events_from_messages": f"""{G} SELECT event_id, event_type,
      CAST(CASE WHEN n % 73 <> 0 THEN CAST(repo_id AS VARCHAR) END AS BIGINT) AS repo_id,
      CAST(CASE WHEN n % 79 <> 0 THEN CAST(actor_id AS VARCHAR) END AS BIGINT) AS actor_id,
      event_created_at AS created_at,
      CASE n % 4 WHEN 0 THEN '{{}}' WHEN 2 THEN '{{"k":' || CAST(repo_id AS VARCHAR) || '}}'
        WHEN 3 THEN '"' || CAST(repo_id AS VARCHAR) || '"' END AS payload
      FROM g""",
    "dim_repos_from_messages": REPOS.replace("FROM g GROUP", "FROM g WHERE n % 73 <> 0 GROUP"),
    "orphan_events": f"""{G} SELECT actor_id, count(*) AS event_count FROM g WHERE actor_id % 10 = 3
      GROUP BY actor_id""",
    "orphan_repos": f"""{G} SELECT repo_id, count(*) AS event_count FROM g WHERE repo_id % 5 = 4
      GROUP BY repo_id""",
    "key_checks": RED + " UNION ALL ".join(_key_check(*check) for check in KEYS),
    "star_join": f"""{G} SELECT event_id, event_type, repo_id, actor_id, event_created_at AS created_at,
      CASE WHEN repo_id % 5 <> 4 THEN repo_name END AS repo_name,
      CASE WHEN actor_id % 10 <> 3 THEN actor_login END AS login FROM g""",
    "repo_time_range": f"""{G} SELECT {FACT} FROM g WHERE repo_id = 5
      AND event_created_at >= TIMESTAMP '2024-01-10' AND event_created_at < TIMESTAMP '2024-01-20'""",
    "actor_lookup": f"""{G} SELECT event_id, event_type, event_created_at, actor_id, actor_login FROM g
      WHERE actor_login = 'user12' AND event_type = 'click'""",
    "pk_violations": f"""{RED} SELECT event_id, count(*) AS row_count FROM red
      GROUP BY event_id HAVING count(*) > 1""",
    "null_violations": f"""{G} SELECT count(*) FILTER (WHERE event_type IS NULL) AS event_type,
      count(*) FILTER (WHERE repo_name IS NULL) AS repo_name FROM g""",
    "rollup_refresh": f"""{G}
      SELECT 'minute' AS rollup, count(DISTINCT date_trunc('minute', event_created_at)) AS key_count,
             count(*) AS event_total FROM g
      UNION ALL SELECT 'types', count(DISTINCT event_type), count(*) FROM g
      UNION ALL SELECT 'repo_activity', count(DISTINCT coalesce(repo_name, '')), count(*) FROM g
      UNION ALL SELECT 'actor_activity', count(DISTINCT actor_login), count(*) FROM g""",
    "incremental_rollup": REPO_ACTIVITY,
    "stream_ingest_fact": FIRST,
    "stream_enriched": f"""{G} SELECT event_id, repo_name, {OWNER} AS repo_owner,
      string_split(repo_name, '/')[2] AS repo_short_name FROM (SELECT *, {STATUS} FROM g) WHERE status = 'ok'""",
    "stream_minute": MINUTES,
    "dedup_shuffled_ids": f"""{RED}, m AS (
      SELECT md5(event_id) AS event_id, kafka_partition, kafka_offset,
        CAST(CASE WHEN kafka_partition = 0 THEN n % 4 ELSE n // 10 % 5 END AS INTEGER) AS batch FROM red)
      SELECT event_id, batch, kafka_partition, kafka_offset FROM m
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY batch, kafka_partition, kafka_offset) = 1""",
    "stream_dedup_recent": f"""{G}, a AS (
      SELECT event_id, kafka_offset, CAST(i - 1 AS INTEGER) AS kafka_partition,
        kafka_timestamp + to_minutes(CASE i WHEN 1 THEN 0 WHEN 2 THEN n % 7 * 10 ELSE n % 7 * 10 + n // 10 % 5 * 15 END) AS t
      FROM g, unnest(CASE WHEN n % 10 = 0 THEN [1, 2, 3] ELSE [1] END) AS u(i)),
      s AS (SELECT *, t - lag(t) OVER w > INTERVAL 30 MINUTE AS starts FROM a
            WINDOW w AS (PARTITION BY event_id ORDER BY t, kafka_partition)),
      p AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY event_id ORDER BY t, kafka_partition) AS part FROM s)
      SELECT event_id, arg_min(kafka_partition, (t, kafka_partition)) AS kafka_partition, kafka_offset,
        min(t) AS kafka_timestamp, count(*) AS arrivals
      FROM p GROUP BY event_id, kafka_offset, part
      HAVING max(t) + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(t)) - INTERVAL 10 MINUTE FROM a)""",
    "late_dimensions": f"""{G}, r AS (
      SELECT 'repos' AS dim, repo_id AS id, event_id, event_created_at AS t,
        CASE WHEN repo_id % 5 <> 4 THEN 0 WHEN repo_id % 10 = 4 THEN 1 END AS came FROM g
      UNION ALL SELECT 'actors', actor_id, event_id, event_created_at,
        CASE WHEN actor_id % 10 <> 3 THEN 0 WHEN actor_id % 20 = 3 THEN 2 END FROM g),
      w AS (SELECT *, CASE WHEN t < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS wave FROM r)
      SELECT dim, id, event_id, CAST(wave AS BIGINT) AS since, CAST(came AS BIGINT) AS settled
      FROM w WHERE came IS NULL OR came > wave""",
    "stream_progress": f"""{RED} SELECT CAST(kafka_partition AS BIGINT) AS batch_id, count(*) AS input_rows, count(*) AS fetched,
      count(*) FILTER (WHERE status IN ('malformed', 'missing_required')) AS invalid,
      count(*) FILTER (WHERE status = 'null_required') AS errors,
      count(*) FILTER (WHERE status IN ('ok', 'bad_timestamp')) AS passed
      FROM red GROUP BY kafka_partition""",
    "live_top10": _top("repo_name"),
    "clustered_lookups": "\n UNION ALL ".join(
        f"SELECT '{name}' AS lookup, event_id, repo_name, actor_login, event_type, event_created_at FROM ({G} SELECT * FROM g) WHERE {asked}"
        for name, asked in {
            "repo": "repo_name = 'org5/repo5'",
            "actor": "actor_login = 'user12'",
            "type": "event_type = 'click'",
            "time": "event_created_at >= TIMESTAMP '2024-01-10' AND event_created_at < TIMESTAMP '2024-01-11'",
            "repo_time": "repo_name = 'org6/repo13' AND event_created_at >= TIMESTAMP '2024-01-05' AND event_created_at < TIMESTAMP '2024-01-25'",
        }.items()
    ),
    "key_checks_incremental": RED + " UNION ALL ".join(_key_check(*c) for c in KEYS if c[0] in ("fact", "events", "repo_activity")),
    "payload_schema": f"""{G}, p AS (
      SELECT event_type, CASE n % 4 WHEN 3 THEN 'STRING' ELSE 'OBJECT' END AS kind, n % 4 = 2 AS has_k FROM g WHERE n % 4 <> 1)
      SELECT event_type, '' AS field, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds, count(*) AS n,
        CAST(1 AS DOUBLE) AS share FROM p GROUP BY event_type
      UNION ALL SELECT event_type, 'k', 'BIGINT', count(*) FILTER (has_k), CAST(count(*) FILTER (has_k) AS DOUBLE) / count(*)
      FROM p GROUP BY event_type HAVING count(*) FILTER (has_k) > 0""",
    "payload_drift": f"""{G}, p AS (
      SELECT event_type, CASE n % 4 WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS batch, n % 4 AS sort FROM g),
      r AS (
        SELECT event_type, batch, '' AS field, CASE sort WHEN 3 THEN 'STRING' ELSE 'OBJECT' END AS kind FROM p WHERE sort <> 1
        UNION ALL SELECT event_type, batch, 'k', 'BIGINT' FROM p WHERE sort = 2),
      c AS (SELECT event_type, batch, field, kind, count(*) AS n FROM r GROUP BY ALL),
      f AS (SELECT *, min(batch) OVER (PARTITION BY event_type) AS t, min(batch) OVER (PARTITION BY event_type, field) AS w,
        min(batch) OVER (PARTITION BY event_type, field, kind) AS x FROM c)
      SELECT CAST(batch AS INTEGER) AS batch, event_type, field, kind, n,
        CASE WHEN batch = t THEN 'type' WHEN batch = w THEN 'field' ELSE 'kind' END AS change FROM f WHERE batch = x""",
}
