"""Chat formatting, embeddings, SQL and the pipeline."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st

import corpus_pipeline
from eventpulse.llm import chat_format, embedding_dedup, language_id, queries
from eventpulse.llm.oracles import ORACLES
from tests.llm import plain

TABLES = ("documents", "benchmark", "conversations", "embeddings", "labels")
CONTROLS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "ok", " ", "\n"])).map("".join)


@given(st.lists(st.tuples(CONTROLS, CONTROLS), max_size=5))
def test_template_reads_back(turns):
    assert chat_format.read_tagged(chat_format.tagged(turns)) == turns
    found = chat_format.locate(chat_format.tagged, turns)
    assert "".join(f[0] for f in found) == chat_format.tagged(turns)
    assert [chat_format.unescape(f[0][f[1] : f[2]]) for f in found] == [text for _, text in turns]
    assert not any(f[3] for f in found)


def test_rewriting_template_is_found():
    def forgets(turns):
        return "".join(f"{r}:{t if k == len(turns) - 1 else '...'};" for k, (r, t) in enumerate(turns))

    found = chat_format.locate(forgets, [("user", "one"), ("assistant", "two"), ("user", "six")])
    assert [f[3] for f in found] == [False, True, True]


def test_texts_that_a_template_drops():
    def hides(turns):
        return "".join(f"<{role}>" + ("" if role == "tool" else text) for role, text in turns)

    found = chat_format.locate(hides, [("user", "hi"), ("tool", "secret"), ("assistant", "yes")])
    assert [f[0] for f in found] == ["<user>hi", "<tool>", "<assistant>yes"]
    assert [(f[1], f[2]) for f in found] == [(6, 8), (6, 6), (11, 14)]


def test_chats(spark):
    long = [(5, t, ("user", "assistant")[t % 2], f"</s> {t} [INST]") for t in range(500)]
    rows = [(1, 0, "user", None), (1, 1, "assistant", "é😀"), (2, 0, None, "x"), (2, 0, None, "x"), (2, None, "assistant", "first"), (None, 3, "assistant", "n"), *long]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_chats(chats)).collect()}
    for conv_id in (1, 2, 5, None):
        own = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv_id].n_turns == len(own) and got[conv_id].rewrites == 0
        assert got[conv_id].turns_sha256 == plain.sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        assert (got[conv_id].loss_chars, got[conv_id].loss_sha256) == (len(said), plain.sha(said))
        assert got[conv_id].formatted_chars == len(chat_format.tagged([(r[2] or "", r[3] or "") for r in own]))
    assert chat_format.digests(chat_format.format_chats(chats.limit(0))).count() == 0


def numbered(turns):
    return "You are helpful.\n" + "".join(f"{k}. {role}: {text}\n" for k, (role, text) in enumerate(turns, 1))


def elides(turns):
    return "".join(f"{role}:{text if k >= len(turns) - 70 else '...'};" for k, (role, text) in enumerate(turns))


@pytest.mark.parametrize("render, rewrites", [(numbered, 0), (elides, 130)])
def test_templates_that_look_far_back(spark, render, rewrites):
    turns = [(("user", "assistant")[t % 2], f"text {t}") for t in range(200)]
    rows = [(c, t, *turn) for c in (1, None) for t, turn in enumerate(turns)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = chat_format.format_chats(chats, render).collect()
    for conv_id in (1, None):
        blocks = sorted((r for r in got if r.conv_id == conv_id), key=lambda r: r.block)
        assert [r.n_turns for r in blocks] == [64, 64, 64, 8] and sum(r.rewrites for r in blocks) == rewrites
        shown = "".join(r.formatted for r in blocks)
        assert (shown == render(turns)) == (not rewrites)
        learned = [r.formatted[a:b] for r in blocks for a, b in r.mask]
        assert learned == [text for role, text in turns if role == "assistant"]


def plain_links(rows):
    out = {i: 0 for i, _, _ in rows}
    links = []
    for a, (i, v, x) in enumerate(rows):
        for j, w, y in rows[:a]:
            if x is None or x != y or any(u is None or len(u) == 0 or any(c is None or not np.isfinite(c) for c in u) or not any(u) for u in (v, w)) or len(v) != len(w):
                continue
            p, q = np.array(v, float), np.array(w, float)
            if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.98:
                links.append((i, j))
                out[i], out[j] = out[i] + 1, out[j] + 1
    part = plain.reach(out, links)
    return {i: (out[i], part[i]) for i in out}


@pytest.mark.parametrize("block", [7, 1024])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 12))
    rows = []
    for k in range(160):
        rows.append((k, [float(np.float32(c)) for c in centre[k % 6] + rng.normal(size=12) * (0.02 + 0.1 * (k % 3))], k % 2))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, [2 * c for c in rows[0][1]], 0), (203, rows[0][1], None), (204, None, 0), (205, [], 0), (206, [0.0] * 12, 0)]
    rows += [(207, [float("nan")] * 12, 0), (208, [None, 1.0], 0), (209, [1.0], 0), (210, [3.0], 0), (211, [-1.0], 0), (212, [float("inf")] * 12, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(frame).collect()}
    assert got == plain_links(rows)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0
    again = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (None, [1.0, 0.0], 0)], frame.schema)
    rows = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_vectors(again).collect())
    assert rows == [(0, 0, 0, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()[list(want.columns)]
    assert sorted(got.columns) == sorted(queries.QUERIES[name](spark, sf_dir).columns)
    want, got = (x.sort_values(list(want.columns)).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    """Each stage against a plain version on its own input."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, taken = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if language_id.has_letter(r.text)}
        if name == "near_dedup":
            assert set(after) == {i for i, (_, part) in plain.near([(i, r.text) for i, r in before.items()]).items() if part == i}
        if name == "decontaminate":
            hit = plain.contamination([(i, r.text) for i, r in before.items()], items)
            assert set(after) == {i for i, _, n, _ in hit if not n}
        if name == "secret_scan":
            assert set(after) == set(before)
            assert all((r.text == before[i].text) == (plain.secret_base(before[i].text) == "") and plain.secret_base(r.text) == "" for i, r in after.items())
        if name == "mixing":
            taken = sum(r.taken for r in after.values())
            size = sum(len(plain.SPACED.findall(r.text)) for r in before.values())
            assert abs(taken - 1.5 * size) <= 20 and set(after) <= set(before)
        else:
            assert docs.columns == columns
    assert taken
