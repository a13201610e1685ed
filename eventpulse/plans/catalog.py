"""Every registered query: (session, folder of the tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.functions import at_rest
from eventpulse.operators import canonical, dedup, dims, enrich, metrics, parse, payloads, quality, rollups
from eventpulse.plans import dashboards, fixtures, leaders
from eventpulse.plans.lake import Lake
from eventpulse.plans.pending import PendingOrphans
from eventpulse.plans.refresh import all_rollups, publish_rollups
from eventpulse.schemas import FACT_COLUMNS, PRIMARY_KEYS, REPOS
from eventpulse.session import pin_utc, work_dir
from eventpulse.sinks.buckets import BucketedTable
from eventpulse.sinks.clustered import ClusteredTable
from eventpulse.sinks.keyaudit import KeyAudit
from eventpulse.sinks.keyindex import KeyIndex
from eventpulse.sinks.tables import BatchTable
from eventpulse.sources.arrays import split_arrays
from eventpulse.sources.landed import explode_responses
from eventpulse.sources.log import read_log_files
from eventpulse.sources.scans import scan_range
from eventpulse.streaming.ingest import start_ingest
from eventpulse.streaming.live import current_minutes, minute_table, start_live_minutes
from eventpulse.streaming.progress import ProgressLog
from eventpulse.streaming.recent import start_recent

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 2, 1)
MICRO_BATCH_BYTES = 256 * 2**30
# Tasks that make and parse messages; None leaves it to the splits of the source's files.
PARSE_PARTITIONS: int | None = None
# So that the test tables have several files of stored ids.
SMALL_FILES = 4096


def _fact(spark: SparkSession, sf_dir: str, repo: bool = True) -> DataFrame:
    return fixtures.fact(fixtures.source(pin_utc(spark), sf_dir), repo)


def _spread_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.fact(parse.spread(fixtures.source(pin_utc(spark), sf_dir), PARSE_PARTITIONS))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_messages(fixtures.redelivered(_spread_fact(spark, sf_dir)))


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.loose_messages(_spread_fact(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.classify(parse.project_envelope(fixtures.envelopes(_messages(spark, sf_dir))))


def parse_flatten(spark, sf_dir):
    return parse.good_rows(_classified(spark, sf_dir))


def quarantine_rows(spark, sf_dir):
    return parse.rejected_rows(_classified(spark, sf_dir)).select(
        "status", "kafka_offset", "kafka_timestamp", F.get_json_object("json", "$.id").alias("event_id")
    )


def landed_responses(spark, sf_dir):
    pages = fixtures.landed_responses(_messages(spark, sf_dir))
    return parse.status_counts(parse.classify(explode_responses(pages)))


def landed_array(spark, sf_dir):
    """All messages as one array in one file, split by brackets."""
    path = work_dir(spark, "landed_array")
    fixtures.landed_array(_messages(spark, sf_dir)).write.text(path)
    return parse.status_counts(parse.classify(split_arrays(spark, path)))


def canonical_event(spark, sf_dir):
    """Encoded as log messages, then decoded leaf by leaf."""
    log = canonical.to_log(canonical.canonicalise(_loose(spark, sf_dir)))
    decoded = parse.parse_once(
        log.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("json")),
        "id string, type string, actor struct<id:string,login:string>, repo struct<id:string,name:string,url:string>,"
        " created_at string, payload string, public string, org string",
    )
    return decoded.select(
        "key", "id", "type", "created_at", "payload", "public", "org",
        F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"), F.col("repo.url").alias("repo_url"),
    )


def type_violations(spark, sf_dir):
    return parse.type_violations(parse.classify(_loose(spark, sf_dir)))


def _with_url(facts: DataFrame) -> DataFrame:
    return facts.withColumn("repo_url", F.concat(F.lit("https://example.org/"), F.col("repo_id")))


REPO_COLUMNS = ["repo_id", "repo_name", "repo_url", "last_updated"]


def dim_repos(spark, sf_dir):
    return dims.build_repos(_with_url(_fact(spark, sf_dir))).select(REPO_COLUMNS)


def dim_repos_upsert(spark, sf_dir):
    """Two generations of the table, the second one upserted."""
    facts = _with_url(_fact(spark, sf_dir))
    turn = datetime(2024, 1, 16)
    old = dims.build_repos(scan_range(facts, end=turn))
    new = dims.build_repos(scan_range(facts, start=turn))
    return dims.upsert_dim(old, new, "repo_id").select(REPO_COLUMNS)


def dim_upserts(spark, sf_dir):
    """M1: five batches by time, the third one repeated and the fourth late, into a bucketed table."""
    facts = _with_url(_fact(spark, sf_dir))
    table = BucketedTable(spark, work_dir(spark, "dim_upserts"), REPOS, "repo_id", buckets=32)
    turns = [None, *(datetime(2024, 1, day) for day in (8, 14, 20, 26)), None]
    for k in (0, 1, 2, 2, 4, 3):
        table.upsert(dims.build_repos(scan_range(facts, turns[k], turns[k + 1])), dims.upsert_dim)
    return table.read().select(REPO_COLUMNS)


def events_normalized(spark, sf_dir):
    events = fixtures.with_repo(fixtures.source(pin_utc(spark), sf_dir)).select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "repo_id",
        F.col("user_id").alias("actor_id"), F.col("ts").alias("event_created_at"), F.col("props").alias("payload"),
    )
    normalised = dims.normalised_events(events)
    return normalised.withColumn("payload_k", F.variant_get("payload", "$.k", "bigint")).drop("payload")


def events_from_messages(spark, sf_dir):
    """M3 and M1's url, from whole messages instead of the fact table."""
    rows = canonical.event_rows(canonical.canonicalise(_loose(spark, sf_dir), keep=canonical.LOG_POSITION))
    events = dims.normalised_events(rows)
    return events.withColumn("payload", F.to_json("payload"))


def dim_repos_from_messages(spark, sf_dir):
    rows = canonical.event_rows(canonical.canonicalise(_loose(spark, sf_dir), keep=canonical.LOG_POSITION))
    return dims.build_repos(rows).select(REPO_COLUMNS)


def orphan_events(spark, sf_dir):
    facts = _fact(spark, sf_dir, repo=False)
    known = dims.build_actors(facts).where("actor_id % 10 <> 3")
    return quality.orphan_counts(facts, known, "actor_id")


def orphan_repos(spark, sf_dir):
    facts = _fact(spark, sf_dir)
    known = dims.build_repos(facts).where("repo_id % 5 <> 4")
    return quality.orphan_counts(facts, known, "repo_id")


def key_checks(spark, sf_dir):
    """The declared key of every table, the fact table being one with redeliveries."""
    facts = _fact(spark, sf_dir)
    tables = all_rollups(facts, AS_OF) | {
        "fact": fixtures.redelivered(facts),
        "repos": dims.build_repos(facts),
        "actors": dims.build_actors(facts),
        "events": facts,
    }
    return quality.key_summary({name: (df, PRIMARY_KEYS[name]) for name, df in tables.items()})


def key_checks_incremental(spark, sf_dir):
    """Three tables in batches, one of them repeated, checked without a scan of the tables."""
    root, facts = work_dir(spark, "key_checks_incremental"), _fact(spark, sf_dir)
    spread = fixtures.shuffled(fixtures.redelivered(facts))
    tables = {
        "fact": (spread, "event_id", "batch"),
        "events": (facts.withColumn("batch", F.col("kafka_offset") % 5), "event_id", "batch"),
        "repo_activity": (rollups.count_by(facts, "repo_name").withColumn("batch", F.lit(0)), "repo_name", "batch"),
    }
    found = []
    for name, (rows, key, batch) in tables.items():
        audit = KeyAudit(spark, f"{root}/{name}", key, buckets=64)
        for batch_id in (0, 1, 1, 2, 3, 4) if name != "repo_activity" else (0,):
            audit.write(rows.where(F.col(batch) == batch_id), batch_id)
        audit.compact()
        found.append(audit.summary(name))
    return reduce(DataFrame.unionAll, found)


def _landed(rows: DataFrame, name: str, batch: str) -> DataFrame:
    """Rows written once by batch, so that each batch reads its own alone."""
    path = work_dir(rows.sparkSession, name)
    rows.write.partitionBy(batch).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _payload_batches(spark, sf_dir) -> list[DataFrame]:
    """Payload shapes of four batches, which differ in the sort of payload; messages are read once, for all of them."""
    rows = canonical.event_rows(canonical.canonicalise(_loose(spark, sf_dir), keep=canonical.LOG_POSITION))
    sort = (F.col("event_id").cast("bigint") % 4).alias("sort")
    events = _landed(dims.normalised_events(rows).select("event_type", "payload", sort), "payload_batches", "sort")
    return [payloads.payload_shapes(events.where(F.col("sort") == sort)) for sort in (0, 2, 3, 1)]


def payload_schema(spark, sf_dir):
    """M3, C4: the schema of payloads by event type, from the counts of four batches."""
    return payloads.payload_schema(payloads.add_shapes(reduce(DataFrame.unionAll, _payload_batches(spark, sf_dir))))


def payload_drift(spark, sf_dir):
    """M3, C4: what each of four batches brings that none before it had."""
    table = BatchTable(spark, work_dir(spark, "payload_drift"), payloads.SHAPES, merge=payloads.add_shapes)
    found = []
    for batch_id, shapes in enumerate(_payload_batches(spark, sf_dir)):
        table.write(shapes, batch_id)
        before = payloads.add_shapes(table.read(batch_id - 1))
        drift = payloads.payload_drift(before, table.read_batch(batch_id))
        found.append(drift.select(F.lit(batch_id).alias("batch"), "*"))
    return reduce(DataFrame.unionAll, found)


def star_join(spark, sf_dir):
    facts = _fact(spark, sf_dir)
    repos = dims.build_repos(facts).where("repo_id % 5 <> 4")
    actors = dims.build_actors(facts).where("actor_id % 10 <> 3")
    events = facts.select(
        "event_id", "event_type", "repo_id", "actor_id", F.col("event_created_at").alias("created_at")
    )
    return dims.star(events, repos, actors).select(*events.columns, "repo_name", "login")


def repo_time_range(spark, sf_dir):
    return scan_range(_fact(spark, sf_dir), datetime(2024, 1, 10), datetime(2024, 1, 20), repo_id=5)


def actor_lookup(spark, sf_dir):
    found = scan_range(_fact(spark, sf_dir, repo=False), actor_login="user12", event_type="click")
    return found.select("event_id", "event_type", "event_created_at", "actor_id", "actor_login")


def rollup_refresh(spark, sf_dir):
    """K2: all rollups published as a version, then read back and summed up."""
    lake = Lake(pin_utc(spark), work_dir(spark, "rollup_refresh"))
    publish_rollups(lake, _fact(spark, sf_dir), AS_OF)
    sums = [
        table.agg(
            F.lit(name).alias("rollup"),
            F.count("*").alias("key_count"),
            F.sum("event_count").alias("event_total"),
        )
        for name, table in lake.rollup_set.read().items()
    ]
    return reduce(DataFrame.union, sums)


def incremental_rollup(spark, sf_dir):
    """Partial counts of four batches by time, one of them repeated, compacted midway."""
    facts = _fact(spark, sf_dir)
    lake = Lake(spark, work_dir(spark, "incremental_rollup"))
    turns = [None, datetime(2024, 1, 8), datetime(2024, 1, 16), datetime(2024, 1, 24), None]
    for batch_id in (0, 1, 2, 2, 3):
        batch = scan_range(facts, turns[batch_id], turns[batch_id + 1])
        lake.partials.write(rollups.partial_counts(batch), batch_id)
        if batch_id == 2:
            lake.partials.compact()
    return lake.totals("repo_activity")


def live_top10(spark, sf_dir):
    """T-2, W3: the leaderboard as of the last of seven batches by time, from levels of their partial counts."""
    facts = _fact(spark, sf_dir)
    lake = Lake(spark, work_dir(spark, "live_top10"))
    days = [None, *(datetime(2024, 1, day) for day in (5, 9, 13, 17, 21, 26)), None]
    for batch_id in range(7):
        batch = scan_range(facts, days[batch_id], days[batch_id + 1])
        lake.partials.write(rollups.partial_counts(batch), batch_id)
        if batch_id in (2, 5):
            lake.partials.compact()
            leaders.index_leaders(lake, ("repo_activity",))
    return leaders.live_leaders(lake, "repo_activity", 10)


def clustered_lookups(spark, sf_dir):
    """M4, M5: the declared lookups, by repository, actor, type and time, on one layout."""
    facts = _fact(spark, sf_dir)
    columns = ["repo_name", "actor_login", "event_type", "event_created_at"]
    table = ClusteredTable(spark, work_dir(spark, "clustered_lookups"), facts.schema, columns, file_rows=SMALL_FILES // 16)
    table.publish(facts)
    asked = {
        "repo": {"repo_name": "org5/repo5"},
        "actor": {"actor_login": "user12"},
        "type": {"event_type": "click"},
        "time": {"start": datetime(2024, 1, 10), "end": datetime(2024, 1, 11)},
        "repo_time": {"repo_name": "org6/repo13", "start": datetime(2024, 1, 5), "end": datetime(2024, 1, 25)},
    }
    found = [table.lookup(**values).select(F.lit(name).alias("lookup"), "event_id", *columns) for name, values in asked.items()]
    return reduce(DataFrame.unionAll, found)


def stream_ingest_fact(spark, sf_dir):
    """The log lands in two waves, events and then redeliveries; the second run
    resumes from the checkpoint and meets stored events."""
    root = work_dir(pin_utc(spark), "stream_ingest_fact")
    lake = Lake(spark, f"{root}/lake")
    messages = _messages(spark, sf_dir)
    again = F.col("kafka_partition") == 1
    for wave in (messages.where(~again), messages.where(again)):
        fixtures.envelopes(wave).write.mode("append").parquet(f"{root}/log")
        log = read_log_files(spark, f"{root}/log", max_bytes_per_trigger=MICRO_BATCH_BYTES)
        start_ingest(log, lake, f"{root}/checkpoint").awaitTermination()
    return lake.fact.read().select(FACT_COLUMNS)


def dedup_shuffled_ids(spark, sf_dir):
    """D3, K6: five batches of ids without any order, one of them repeated, through the index of stored keys."""
    rows = fixtures.shuffled(fixtures.redelivered(_fact(spark, sf_dir, repo=False)))
    root = work_dir(spark, "dedup_shuffled_ids")
    index = KeyIndex(spark, f"{root}/keys", file_keys=SMALL_FILES, fan=2)
    columns = ["event_id", "batch", "kafka_partition", "kafka_offset"]
    landed = _landed(rows.select(columns), "shuffled_ids", "batch").select(columns)
    table = BatchTable(spark, f"{root}/rows", landed.schema)
    for batch_id in (0, 1, 1, 2, 3, 4):
        batch = landed.where(F.col("batch") == batch_id)
        known = index.near(batch, upto=batch_id - 1)
        table.write(dedup.drop_seen(dedup.dedup_batch(batch), known, keys=batch), batch_id)
        index.write(table.read_batch(batch_id), batch_id)
        index.compact()
    return table.read()


def stream_dedup_recent(spark, sf_dir):
    """Bursts of an id over the file stream, whose first half ends in the middle of some; resumed from the checkpoint."""
    root = work_dir(pin_utc(spark), "stream_dedup_recent")
    rows = fixtures.bursts(_fact(spark, sf_dir, repo=False))
    schema = T.StructType([*at_rest(rows).schema.fields, T.StructField("arrivals", T.LongType())])
    table = BatchTable(spark, f"{root}/recent", schema)
    turn = F.lit(datetime(2024, 1, 16))
    late = F.col("kafka_timestamp") >= turn
    for wave in (rows.where(~late), rows.where(late)):
        wave.write.mode("append").parquet(f"{root}/log")
        log = spark.readStream.schema(rows.schema).parquet(f"{root}/log")
        query = start_recent(
            log, table, f"{root}/checkpoint", "30 minutes", "10 minutes", state_partitions=spark.sparkContext.defaultParallelism
        )
        query.awaitTermination()
    return table.read()


def late_dimensions(spark, sf_dir):
    """Two waves of events and a third with dimension rows alone; every wave is repeated."""
    facts = _fact(spark, sf_dir).select("event_id", "event_created_at", "repo_id", "actor_id")
    turn = datetime(2024, 1, 16)
    repos, actors = facts.select("repo_id").distinct(), facts.select("actor_id").distinct()
    waves = [
        (scan_range(facts, end=turn), repos.where("repo_id % 5 <> 4"), actors.where("actor_id % 10 <> 3")),
        (scan_range(facts, start=turn), repos.where("repo_id % 10 = 4"), actors.limit(0)),
        (facts.limit(0), repos.limit(0), actors.where("actor_id % 20 = 3")),
    ]
    pending = PendingOrphans(spark, work_dir(spark, "late_dimensions"), {"repos": "repo_id", "actors": "actor_id"})
    for batch_id in (0, 1, 1, 2, 2):
        events, new_repos, new_actors = waves[batch_id]
        pending.write(events, {"repos": new_repos, "actors": new_actors}, batch_id)
        pending.compact()
    return pending.history()


def stream_progress(spark, sf_dir):
    """What the log tells of an ingest in two runs, after both have ended."""
    root = work_dir(pin_utc(spark), "stream_progress")
    lake, log = Lake(spark, f"{root}/lake"), ProgressLog(spark, f"{root}/progress")
    messages = _messages(spark, sf_dir)
    again = F.col("kafka_partition") == 1
    spark.streams.addListener(log)
    try:
        for wave in (messages.where(~again), messages.where(again)):
            fixtures.envelopes(wave).write.mode("append").parquet(f"{root}/log")
            landed = read_log_files(spark, f"{root}/log", max_bytes_per_trigger=MICRO_BATCH_BYTES)
            query = start_ingest(landed, lake, f"{root}/checkpoint")
            query.awaitTermination()
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
    counters = [F.col("counters")[name].alias(name) for name in ("fetched", "invalid", "errors", "passed")]
    return log.read().select("batch_id", "input_rows", *counters)


def stream_enriched(spark, sf_dir):
    """Names split while the log is ingested."""
    root = work_dir(pin_utc(spark), "stream_enriched")
    lake = Lake(spark, f"{root}/lake", enrich=True)
    fixtures.envelopes(_messages(spark, sf_dir)).write.parquet(f"{root}/log")
    log = read_log_files(spark, f"{root}/log", max_bytes_per_trigger=MICRO_BATCH_BYTES)
    start_ingest(log, lake, f"{root}/checkpoint").awaitTermination()
    return lake.fact.read().select("event_id", "repo_name", "repo_owner", "repo_short_name")


def stream_minute(spark, sf_dir):
    root = work_dir(pin_utc(spark), "stream_minute")
    events = fixtures.source_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("event_created_at"))
    table = minute_table(spark, f"{root}/minutes")
    cores = spark.sparkContext.defaultParallelism
    query = start_live_minutes(events, table, f"{root}/checkpoint", state_partitions=cores)
    query.awaitTermination()
    return current_minutes(table)


QUERIES: dict[str, Query] = {
    "fact_projection": lambda s, d: _fact(s, d),
    "parse_flatten": parse_flatten,
    "record_status_counts": lambda s, d: parse.status_counts(_classified(s, d)),
    "quarantine_rows": quarantine_rows,
    "landed_responses": landed_responses,
    "landed_array": landed_array,
    "canonical_event": canonical_event,
    "type_violations": type_violations,
    "dedup_first_wins": lambda s, d: dedup.dedup_batch(parse_flatten(s, d)),
    "ingest_metrics": lambda s, d: metrics.ingest_metrics(_classified(s, d)),
    "duplicate_rate": lambda s, d: metrics.duplicate_rate(metrics.ingest_metrics(_classified(s, d))),
    "events_per_minute": lambda s, d: dashboards.minute_series(_fact(s, d, repo=False)),
    "event_type_distribution": lambda s, d: dashboards.type_distribution(_fact(s, d, repo=False)),
    "repo_activity": lambda s, d: rollups.count_by(_fact(s, d), "repo_name"),
    "actor_activity": lambda s, d: rollups.actor_activity(_fact(s, d, repo=False), AS_OF),
    "owner_activity": lambda s, d: rollups.owner_activity(_fact(s, d)),
    "top10_repos": lambda s, d: dashboards.top_repos(_fact(s, d)),
    "top10_actors": lambda s, d: dashboards.top_actors(_fact(s, d, repo=False)),
    "repo_enriched": lambda s, d: enrich.enrich_repo(_fact(s, d).select("event_id", "repo_name")),
    "dim_repos": dim_repos,
    "dim_actors": lambda s, d: dims.build_actors(_fact(s, d, repo=False)).select("actor_id", "login"),
    "dim_repos_upsert": dim_repos_upsert,
    "dim_upserts": dim_upserts,
    "dim_repos_from_messages": dim_repos_from_messages,
    "events_normalized": events_normalized,
    "events_from_messages": events_from_messages,
    "orphan_events": orphan_events,
    "orphan_repos": orphan_repos,
    "star_join": star_join,
    "repo_time_range": repo_time_range,
    "actor_lookup": actor_lookup,
    "pk_violations": lambda s, d: quality.pk_violations(
        fixtures.redelivered(_fact(s, d, repo=False)), "event_id"
    ),
    "null_violations": lambda s, d: quality.null_violations(_fact(s, d), ["event_type", "repo_name"]),
    "key_checks": key_checks,
    "key_checks_incremental": key_checks_incremental,
    "payload_schema": payload_schema,
    "payload_drift": payload_drift,
    "rollup_refresh": rollup_refresh,
    "incremental_rollup": incremental_rollup,
    "live_top10": live_top10,
    "clustered_lookups": clustered_lookups,
    "stream_ingest_fact": stream_ingest_fact,
    "stream_minute": stream_minute,
    "stream_progress": stream_progress,
    "stream_enriched": stream_enriched,
    "dedup_shuffled_ids": dedup_shuffled_ids,
    "stream_dedup_recent": stream_dedup_recent,
    "late_dimensions": late_dimensions,
}
