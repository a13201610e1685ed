"""Exact dedup, spelling variants and hard negatives against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventpulse.llm import exact_dedup, hard_negatives, queries, spelling
from tests.llm import plain

DOCS = "doc_id long, text string"
CLASH = "doc_id long, text string, OPEN string, digest string, grp int, n int, word string, sieve_bucket int"


def copies(rows):
    out = []
    for i, text in rows:
        same = [j for j, other in rows if plain.small(other) == plain.small(text)]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, plain.sha(plain.small(text))))
    return sorted(out, key=str)


def some_texts():
    long = "Word and é " * 2_000
    rows = [(1, "Same"), (2, "sAME"), (3, "SAME "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, long), (9, long.lower()), (10, long + "x")]
    rows += [(11, long[:-1] + "x"), (12, "x" * 64 + "a"), (13, "x" * 64 + "b"), (14, "İ"), (15, "i̇"), (16, "K"), (17, "k"), (None, "only"), (None, "Only")]
    return rows + [(None, "same"), (20, "twice"), (20, "twice"), (20, "other"), (21, "other"), (-3, "É"), (552315331, "q")]


def test_exact_duplicates(spark):
    rows = some_texts()
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted((tuple(r) for r in exact_dedup.exact_duplicates(frame, True).collect()), key=str)
    assert got == copies(rows)
    lazy = exact_dedup.exact_duplicates(frame).collect()
    assert sorted((tuple(r)[:4] for r in lazy), key=str) == sorted((r[:4] for r in got), key=str)
    # a text of a length of its own, or with a beginning of its own, is never digested
    undigested = {r.doc_id for r in lazy if r.text_sha256 is None}
    assert {3, 552315331} <= undigested and not {1, 2, 8, 9, 12, 13} & undigested
    assert exact_dedup.exact_duplicates(frame.limit(0)).count() == 0


def test_deduplicated_rows_and_clashing_columns(spark):
    rows = [(i, text, "o", "d", 1, 2, "w", 3) for i, text in some_texts()]
    frame = spark.createDataFrame(rows, CLASH).repartition(3)
    out = exact_dedup.deduplicated(frame)
    assert out.schema == frame.schema
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = {(plain.small(text), i) for i, text in some_texts()}
    last = {t: max((i for u, i in want if u == t and i is not None), default=None) for t, _ in want}
    assert sorted((plain.small(t), i) for i, t in got if i is not None) == sorted((t, i) for t, i in last.items() if i is not None)
    assert [plain.small(t) for i, t in got if i is None] == ["only"]
    assert exact_dedup.exact_duplicates(frame).count() == len(rows)


def test_exact_dedup_uses_no_python(spark):
    plan = queries.QUERIES["op11_exact_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "InArrow", "InPandas", "MapPartitions"))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 90), st.integers(1, 70), st.integers(1, 90), st.integers(1, 9), st.integers(0, 2**32))
def test_strassen(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()
    # sums on the way may leave 64 bits, the result does not
    a, b = a * 2**20, np.where(rng.random((k, n)) < 0.1, 1, 0)
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


@given(st.integers(-(2**63), 2**63 - 1))
def test_window(p):
    low, high = (int(x[0]) for x in hard_negatives.window_of(np.array([p])))
    for n in (low - 1, low, high, high + 1):
        assert (50 * p <= 100 * n <= 95 * p) == (low <= n <= high)


@pytest.mark.parametrize("sizes", [(2048, 4096, 512), (3, 7, 4)])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, size in zip(("ANCHORS", "CANDIDATES", "PIECE"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = np.random.default_rng(5)
    rows = [(k, k % 3, [float(np.float32(c)) for c in np.abs(rng.normal(size=6))]) for k in range(60)]
    rows += [(60, 0, rows[0][2]), (61, 0, rows[0][2]), (70, 1, rows[0][2]), (71, None, rows[0][2]), (72, 0, None), (73, 0, [None, 1.0]), (74, 0, [float("nan")])]
    rows += [(75, 0, [float("inf")] * 6), (76, 0, []), (77, 1, [1.0]), (78, 9, rows[1][2]), (80, 0, [-1.0] * 6), (None, 0, rows[0][2])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    for given_rows, shown in ((rows, frame), (rows + [(90, 2, [1e200] * 6), (91, 2, [1e12] * 6)], None)):
        shown = shown or spark.createDataFrame(given_rows, frame.schema).repartition(4)
        found = hard_negatives.hard_negatives(shown, spark_multiple_of(5))
        assert sorted(tuple(r) for r in found.collect()) == plain.mined(given_rows, lambda i: i % 5 == 0)
    assert hard_negatives.hard_negatives(frame.limit(0), spark_multiple_of(5)).count() == 0
    twice = hard_negatives.hard_negatives(frame.unionByName(frame), spark_multiple_of(5))
    assert sorted(tuple(r) for r in twice.collect()) == plain.mined(rows, lambda i: i % 5 == 0)


def spark_multiple_of(n):
    from pyspark.sql import functions as F

    return F.col("vec_id") % n == 0


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 6)))
        weight = [rng.randint(1, 9) for _ in places]
        pairs = [(weight[i] + weight[j], (places[i], places[j])) for i in range(len(places)) for j in range(i) if places[i] - places[j] >= 2]
        got = spelling.pivots(places, weight)
        assert got is not None and got[1] - got[0] >= 2
        assert sum(weight[places.index(at)] for at in got) == min(cost for cost, _ in pairs)


def edited(rng, word):
    k, c = rng.randrange(len(word) + 1), rng.choice("abéÿz")
    return rng.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]])


def test_near_words(spark):
    """All pairs of words over few letters, so that grams repeat and tie."""
    rng = random.Random(7)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for letters in ("ab", "abc", "abéÿ", "abcdefgh") for _ in range(40)]
    words = sorted({w for word in base for w in (word, edited(rng, word), edited(rng, edited(rng, word))) if len(w) >= 6} | {"aaaaaa", "aaaaaaa", "aaaaaaaa"})
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(4)
    got = {tuple(r) for r in spelling.near_words(frame).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and plain.one_edit(a, b)}


def test_spelling_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    monkeypatch.setattr(spelling, "TABLE", 20)
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    base += [edited(rng, w) for w in base] + [edited(rng, edited(rng, w)) for w in base]
    rows = []
    for i in range(400):
        words = [w if rng.random() < 0.9 else w.upper() for w in rng.choices(base, [2.0 ** -(k % 9) for k in range(len(base))], k=60)]
        rows.append((i, rng.choice([" ", ", ", "×1", "\n"]).join(words)))
    rows += [(None, None), (None, "Naïveté naïvetés " * 40), (7, ""), (8, "x" * 5000), (9, "12 É ÷"), rows[0], rows[0]]
    frame = spark.createDataFrame([(*r, 1, "n") for r in rows], DOCS + ", n int, word string").repartition(4)
    got = sorted((tuple(r) for r in spelling.spelling_variants(frame).collect()))
    want = plain.spelling(plain.spelled(rows))
    assert got == want
    assert any(r[2] != (r[1] or r[0]) for r in want) and any(r[1] is None and r[4] for r in want)
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


def test_spelling_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op12_spelling"](spark, sf_dir).collect())
    assert got == plain.spelling(plain.spelled(docs)) and got
