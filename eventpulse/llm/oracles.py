r"""SQL for the registered queries, where it can express them.

Without SQL: op2 and op7 (places of matches), op4 (order seeded by a hash), op6 and
op8 (learned), op12 (crc32), pipeline. Tests compare those with plain versions or measure them.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SMALL = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CONTROL = r"[<\[]\\*/?(?:s>|INST\])"

#: From ids (id) and links (a, b in both directions): the smallest id reachable.
_REACH = """
  reach AS (SELECT id AS node, id AS other FROM ids UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
  parts AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

ORACLES: dict[str, str] = {
    "op1_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(21 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS rewrites
FROM t GROUP BY conv_id""",
    "op3_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_SMALL}, '{_SPACED}') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x FROM w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS u(i)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  both_ AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
  ids AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN parts ON node = d.doc_id""",
    "op5_decontaminate": f"""
WITH b AS (SELECT item_id, regexp_extract_all({_SMALL}, '{_ALNUM}') AS w FROM benchmark),
  d AS (SELECT doc_id, regexp_extract_all({_SMALL}, '{_ALNUM}') AS w FROM documents),
  v AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS x
        FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
  sizes AS (SELECT DISTINCT n FROM v),
  o AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS x FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
  m AS (SELECT o.doc_id, o.i, o.n, v.item_id FROM o JOIN v ON o.n = v.n AND o.x = v.x),
  hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
  item AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)""",
    "op9_embedding_dedup": f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL),
  links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM e p JOIN e q ON p.label = q.label AND p.vec_id <> q.vec_id
            AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.98),
  ids AS (SELECT vec_id AS id FROM embeddings),{_REACH}
SELECT x.vec_id, (SELECT count(*) FROM links WHERE a = x.vec_id) AS n_links, component_id, x.vec_id = component_id AS kept
FROM embeddings x JOIN parts ON node = x.vec_id""",
    "op10_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
  o AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS x FROM d, unnest(range(1, len(w) - 48)) AS u(i)),
  f AS (SELECT x, min(doc_id) AS first FROM o GROUP BY x),
  gone AS (SELECT DISTINCT doc_id, p FROM o JOIN f USING (x), unnest(range(i, i + 50)) AS u(p) WHERE doc_id > first),
  words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
  kept AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS text
           FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({_SMALL}) AS text_sha256 FROM documents),
  g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT a AS anchor_id, b AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
  n AS (SELECT p.*, b AS negative_id, score AS negative_score,
          CAST(row_number() OVER (PARTITION BY a, p.positive_id ORDER BY score DESC, b) AS INTEGER) AS rank
        FROM p JOIN s ON a = anchor_id AND NOT same
        AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
