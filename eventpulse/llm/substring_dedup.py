"""Substring dedup with difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: for any two positions i and j
some offset below PERIOD makes i + offset and j + offset both positions of the
cover. So any passage of ``PERIOD - 1 + ANCHOR`` = 50 words that stands in two
documents holds an anchor of ANCHOR words that is hashed in both, although only 6
of 31 positions are hashed.

1. Anchors are counted; those in one place only are dropped.
2. A repeated anchor is extended: the 50-word windows that hold it are hashed,
   and each window's smallest doc_id is found (a combined aggregate, so frequent
   passages shrink before the shuffle).
3. A window that also starts in a smaller doc_id covers words to remove.

Documents with the same words as a whole are found first, by a digest; only the
smallest doc_id of each takes part, the others lose all words if they have 50.
Windows are compared by two 64-bit hashes over their words' hashes: among 10**12
windows the chance of any clash is below 10**-13. Null or empty texts have no words. A null doc_id is neither
smaller nor larger than another; its row keeps its words. Rows that repeat a
doc_id are judged each for itself and don't remove each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import discard, only, small_batches, stored
from eventpulse.llm.words import STEPS, slices, windows, words_of

WINDOW = 50
PERIOD = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
ANCHOR = WINDOW - PERIOD + 1
EMPTY = sha256(b"").hexdigest()


def anchor_places(n_words: int) -> np.ndarray:
    """Positions of the cover at which an anchor fits into n words."""
    rounds = np.arange(n_words // PERIOD + 1)[:, None] * PERIOD
    at = (rounds + COVER).ravel()
    return at[at <= n_words - ANCHOR]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[str]]]:
    for batch in slices(batches):
        words = words_of(batch.column(1))
        own = [words.hashes[lo:hi] for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        yield batch, own, batch.column(1).to_pylist()


def _key(own: np.ndarray) -> tuple[int, int]:
    digest = blake2b(own.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, texts in _rows(batches):
        keys = [_key(own) for own in rows]
        sha = [sha256(b" ".join((text or "").encode().split())).hexdigest() for text in texts]
        anchors = []
        for own in rows:
            at = anchor_places(len(own)) if len(own) >= WINDOW else np.zeros(0, np.int64)
            anchors.append(windows(own, ANCHOR)[at].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(own) for own in rows], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
             pa.array([k[1] for k in keys], pa.int64()), pa.array(sha, pa.string()), pa.array(anchors, pa.list_(pa.int64()))],
            ["doc_id", "n_words", "k", "k2", "sha", "anchors"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that hold a repeated anchor of the document."""
    for batch, rows, _ in _rows(batches):
        for doc_id, k, hits, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), rows, strict=True):
            if _key(own)[0] != k:
                continue
            at = anchor_places(len(own))[hits.values.to_numpy()]
            last = len(own) - WINDOW
            mark = np.zeros(len(own) + 2, np.int64)
            np.add.at(mark, np.maximum(at - PERIOD + 1, 0), 1)
            np.add.at(mark, np.minimum(at, last) + 1, -1)
            start = np.flatnonzero(np.cumsum(mark)[: last + 1])
            n = len(start)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(windows(own, WINDOW, step)[start].view(np.int64)) for step in STEPS), pa.array(np.full(n, doc_id, np.int64)), pa.array(np.full(n, k, np.int64)), pa.array(start.astype(np.int32))],
                ["h", "h2", "doc_id", "k", "start"],
            )


def covered(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Which of n words lie in a window with one of these starts."""
    mark = np.zeros(n_words + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    return np.cumsum(mark)[:n_words] > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, texts in _rows(batches):
        out = []
        for doc_id, k, starts, own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), rows, texts, strict=True):
            if _key(own)[0] == k:
                gone = covered(starts.values.to_numpy(), len(own))
                out.append((doc_id, k, int(gone.sum()), " ".join(compress(_split(text), ~gone))))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "k", "n_removed", "kept"])


def _split(text: str) -> list[str]:
    return [word.decode() for word in text.encode().split()]


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text where words went, else null), kept_sha256 for each row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    full = stored(rows.mapInArrow(_anchors, "doc_id long, n_words long, k long, k2 long, sha string, anchors array<long>"), "anchors")
    signs = stored(full.drop("anchors"), "signs")
    long = full.where(f"doc_id is not null and n_words >= {WINDOW}")
    first = stored(signs.where(f"doc_id is not null and n_words >= {WINDOW}").groupBy("k", "k2").agg(F.min("doc_id").alias("first")), "first")
    lead = long.join(first, ["k", "k2"]).where("doc_id = first").select("doc_id", "k", "anchors")
    lead = stored(lead.dropDuplicates(["doc_id", "k"]), "lead")
    discard(full)
    # what is joined is stored first: Spark splits a hot key of a join, but not one that it also aggregates by
    many = stored(lead.select(F.explode("anchors").alias("h")).groupBy("h").count().where("count > 1").select("h"), "many")
    hits = lead.select("doc_id", "k", F.posexplode("anchors").alias("i", "h")).join(many, "h", "left_semi")
    hits = stored(hits.groupBy("doc_id", "k").agg(F.collect_list("i").alias("hits")), "hits")
    discard(lead)
    texts = only(rows, hits.select("doc_id")).distinct().join(hits, "doc_id").select("doc_id", "text", "k", "hits")
    found = stored(texts.mapInArrow(_windows, "h long, h2 long, doc_id long, k long, start int"), "windows")
    least = found.groupBy("h", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    least = stored(least.select("h", "h2", "lo"), "least")
    gone = found.join(least, ["h", "h2"]).where("doc_id > lo").groupBy("doc_id", "k").agg(F.collect_list("start").alias("starts"))
    gone = stored(gone, "gone")
    discard(found)
    texts = only(rows, gone.select("doc_id")).distinct().join(gone, "doc_id").select("doc_id", "text", "k", "starts")
    kept = texts.mapInArrow(_kept, "doc_id long, k long, n_removed long, kept string")
    copies = signs.join(first, ["k", "k2"], "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    joined = copies.join(kept.withColumnRenamed("n_removed", "some"), ["doc_id", "k"], "left")
    text = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept"))
    return joined.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("some", F.lit(0))).cast("long").alias("n_removed"),
        text.alias("kept"),
        F.when(text.isNull(), F.col("sha")).otherwise(F.sha2(text, 256)).alias("kept_sha256"),
    )
