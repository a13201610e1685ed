"""Words and runs of words that a polynomial hash takes for equal, and rows with clashing columns."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventpulse.llm import decontaminate, language_id, near_dedup, substring_dedup, words
from tests.llm import plain


def thue_morse(n, one, two, sep=""):
    """The sequence over two words and its complement: equal modulo 2**64 for any polynomial from 1024 on."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return sep.join((one, two)[b] for b in bits), sep.join((two, one)[b] for b in bits)


def hashes(*texts):
    return words.words_of(pa.array(texts)).hashes


@pytest.mark.parametrize("n", [8, 64, 120, 1024, 4096])
def test_words_of_two_letters_differ(n):
    a, b = hashes(*thue_morse(n, "a", "b"))
    assert a != b


def test_word_hash_depends_on_each_byte():
    rng = np.random.default_rng(0)
    for n in (1, 7, 8, 9, 16, 17, 40, 127, 128, 129, 300):
        base = rng.integers(97, 123, n).astype(np.uint8)
        texts = [base.tobytes().decode()]
        for k in range(n):
            other = base.copy()
            other[k] = 48
            texts.append(other.tobytes().decode())
        texts += [texts[0] + "a", texts[0] + "\x00"]
        assert len(set(hashes(*texts).tolist())) == len(texts)
        # a word has one hash wherever it stands
        assert hashes("xx " + texts[0] + " yy")[1] == hashes(texts[0])[0]


@pytest.mark.parametrize("width", [1, 2, 3, 5, 20, 50, 64, 1024])
def test_runs_of_words(width):
    one, two = (hashes(text) for text in thue_morse(1024, "a", "b", " "))
    got, other = words.windows(one, width), words.windows(two, width)
    assert len(got) == 1024 - width + 1
    plain_runs = [tuple(one[k : k + width].tolist()) for k in range(len(got))] + [tuple(two[k : k + width].tolist()) for k in range(len(got))]
    assert len(set(got.tolist()) | set(other.tolist())) == len(set(plain_runs))
    assert not len(words.windows(one[: width - 1], width))


def test_operators_tell_such_texts_apart(spark):
    one, two = thue_morse(1024, "a", "b")
    runs = thue_morse(1024, "a", "b", " ")
    rows = [(1, one), (2, two), (3, " ".join([one, *("f%d" % k for k in range(60))])), (4, " ".join([two, *("f%d" % k for k in range(49))])), (5, runs[0]), (6, runs[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == plain.near(rows) and got[2][1] == 2
    bench = spark.createDataFrame([(1, one), (2, runs[0])], "item_id long, text string")
    found = decontaminate.matches(docs, bench).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == sorted(plain.contamination(rows, [(1, one), (2, runs[0])]))
    kept = substring_dedup.repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, kept)) == sorted(plain.passages(rows))


def test_columns_of_any_name(spark):
    rows = [(k, "the house is red and the cat sleeps " * 3 + f"x{k}", "bb") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    extra = ["_searched_text", "_judged_text", "in_sieve", "SIEVE_BUCKET", "cls", "place", "lost", "spans", "_pattern"]
    docs = docs.withColumns({name: F.lit(name) for name in extra})
    bench = spark.createDataFrame([(1, "x3")], "item_id long, text string")
    for out, n in ((decontaminate.clean(docs, bench), 11), (language_id.spoken(docs), 12), (near_dedup.one_of_each(docs), 1)):
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == n and all(r[name] == name for r in got for name in extra)


def test_language_of_three_texts_stays(spark):
    """A language with a few short labelled texts is learned from all of its grams."""
    rows = [(k, "the house is red and the cat sleeps in the garden of the old man " * 20, "bb") for k in range(40)]
    few = ["ny trano mena", "ny saka matory", "ny zaridaina mena"]
    rows += [(1000 + 4 * k, text, "mg") for k, text in enumerate(few)]
    docs = spark.createDataFrame([*rows, (2000, "ny saka mena", None)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language_id.spoken(docs).collect()}
    assert {1000, 1004, 1008, 2000} <= kept


def test_texts_of_several_mb(spark):
    rows = [(1, "w%d " * 10 % tuple(range(10)) * 80_000), (2, "é" * 3_000_000), (3, "short text"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "w8 w9 w0 w1 w2 w3 w4 w5 w6 w7")], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.matches(docs, bench).collect()}
    assert found[1] == (800_000, 799_990) and found[2] == (1, 0) and found[3] == (2, 0)
    assert {r.doc_id: r.n_shingles for r in near_dedup.near_duplicates(docs).collect()} == {1: 10, 2: 1, 3: 1, 4: 0}


def test_what_is_shuffled_by_class_holds_numbers(spark, monkeypatch):
    """Lists and pairs named by digests took 4.57 times the input at 30 GB."""
    found, kept = {}, near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, name: found.setdefault(name, df.dtypes) and kept(df, name))
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (2, "other"), (3, "other"), (4, None)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}
    for name in ("entries", "lists", "heads", "pairs", "ends", "near", "linked", "labelled", "mixed", "across"):
        assert not any("binary" in kind for _, kind in found[name]), name
