"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the others are texts of unknown kind. With
class prior p the risk of a scorer g is

    p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)])

whose second part estimates the risk on clean texts from unlabelled ones and can't
fall below 0; where a batch makes it negative, the step ascends it instead. The
scorer is linear over the distinct words of a text (lower-case letters and digits,
hashed to DIMENSIONS, only those that tell positives from others), fitted with numpy by Adam on a bounded sample: at most
MAX_POSITIVE positives and MAX_UNLABELLED other texts, chosen by a hash of doc_id.
The prior is the share of positives among all labels that may be used. The logit is
shifted so that 0.7 lies where the estimated F1 is best.

Null or empty texts have no words and get the score of the intercept. Null labels
are not used, nor are rows with a null doc_id for learning; with no positives or no
other texts all scores are 0. Contradicting labels of one doc_id count as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import only, remainder, small_batches, stored
from eventpulse.llm.words import ALNUM, slices, words_of

DIMENSIONS = 1 << 18
MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
MIN_TEXTS = 3
MIN_Z = 5.0
EPOCHS = 40
BATCHES = 20
RATE = 0.02
DECAY = 1e-4
CUT = 0.7


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float
    scale: float
    shift: float


class Texts(NamedTuple):
    """Distinct word buckets of texts, one after the other, and the bounds of each text."""

    buckets: np.ndarray
    bounds: np.ndarray


def word_buckets(column: pa.Array) -> Texts:
    words = words_of(column, ALNUM, lower=True)
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    code = np.unique(row * DIMENSIONS + (words.hashes >> np.uint64(46)).astype(np.int64))
    return Texts(code % DIMENSIONS, np.searchsorted(code, np.arange(len(words.bounds)) * DIMENSIONS))


def linear(texts: Texts, weights: np.ndarray, bias: float) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(weights[texts.buckets])))
    return total[texts.bounds[1:]] - total[texts.bounds[:-1]] + bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _part(texts: Texts, rows: np.ndarray) -> Texts:
    size = np.diff(texts.bounds)[rows]
    ends = np.cumsum(size)
    at = np.arange(size.sum()) + np.repeat(texts.bounds[rows] - (ends - size), size)
    return Texts(texts.buckets[at], np.concatenate(([0], ends)))


def telling(positive: Texts, other: Texts) -> np.ndarray:
    """Words whose share of positive texts differs from that of other texts by MIN_Z standard errors."""
    n_pos, n_other = len(positive.bounds) - 1, len(other.bounds) - 1
    in_pos, in_other = (np.bincount(part.buckets, minlength=DIMENSIONS) for part in (positive, other))
    total = in_pos + in_other
    share = total / (n_pos + n_other)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_pos + 1 / n_other))
    return (total >= MIN_TEXTS) & (np.abs(in_pos / n_pos - in_other / n_other) >= MIN_Z * error)


def fit(positive: Texts, other: Texts, prior: float, seed: int = 0) -> Scorer:
    """Minimise the non-negative risk with the logistic loss."""
    n_pos, n_other = len(positive.bounds) - 1, len(other.bounds) - 1
    if not n_pos or not n_other:
        return Scorer(np.zeros(DIMENSIONS), 0.0, 0.0, -60.0)
    used = telling(positive, other)
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(DIMENSIONS), float(np.log(prior / (1 - prior)))
    m, v, t = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1), 0
    for _ in range(EPOCHS):
        split_p, split_u = (np.array_split(rng.permutation(n), BATCHES) for n in (n_pos, n_other))
        for rows_p, rows_u in zip(split_p, split_u, strict=True):
            if not len(rows_p) or not len(rows_u):
                continue
            p, u = _part(positive, rows_p), _part(other, rows_u)
            gp, gu = linear(p, w, bias), linear(u, w, bias)
            clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            rise_p, rise_u = sigmoid(gp) / len(gp), sigmoid(gu) / len(gu)
            sign = 1.0 if clean >= 0 else -1.0
            toxic = prior * (sigmoid(gp) - 1) / len(gp) if sign > 0 else np.zeros(len(gp))
            slope_p, slope_u = toxic - sign * prior * rise_p, sign * rise_u
            code = np.concatenate((p.buckets, u.buckets))
            each = np.concatenate((np.repeat(slope_p, np.diff(p.bounds)), np.repeat(slope_u, np.diff(u.bounds))))
            slope = np.append(np.bincount(code, each, DIMENSIONS) * used + DECAY * w, slope_p.sum() + slope_u.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
            step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, bias = w - step[:-1], bias - float(step[-1])
    gp, gu = np.sort(linear(positive, w, bias)), np.sort(linear(other, w, bias))
    cut = np.unique(np.quantile(gp, np.linspace(0, 1, 401)))
    recall = 1 - np.searchsorted(gp, cut) / n_pos
    flagged = prior * recall + np.maximum((1 - np.searchsorted(gu, cut) / n_other) - prior * recall, 0)
    f1 = 2 * prior * recall / (prior + flagged)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = float(cut[best[0]])
    below = gu[gu < at]
    at = (at + float(below[-1])) / 2 if len(below) else at
    return Scorer(w, bias, 1.0, float(np.log(CUT / (1 - CUT))) - at)


def _sampled(ids: DataFrame, most: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(most)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = word_buckets(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(texts.bounds, pa.int32()), pa.array(texts.buckets, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(2), lists], ["positive", "buckets"])


def learn(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), both limited to what may be used."""
    small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).alias("positive")), "labels")
    n, n_pos = known.agg(F.count("*"), F.coalesce(F.sum(F.col("positive").cast("long")), F.lit(0))).first()
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.select("doc_id").distinct()
    positive = _sampled(ids.join(known.where("positive"), "doc_id", "left_semi"), MAX_POSITIVE).withColumn("positive", F.lit(True))
    other = _sampled(ids, MAX_UNLABELLED).withColumn("positive", F.lit(False))
    chosen = stored(positive.unionByName(other), "fit")
    texts = only(rows, chosen.select("doc_id")).join(chosen, "doc_id").select("doc_id", "text", "positive")
    got = texts.mapInArrow(_buckets, "positive boolean, buckets array<int>").toArrow().combine_chunks()
    side = got["positive"].to_numpy().astype(bool)
    parts = []
    for wanted in (True, False):
        lists = got.filter(pa.array(side == wanted))["buckets"].combine_chunks()
        sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64) if len(lists) else np.zeros(0, np.int64)
        parts.append(Texts(np.asarray(lists.flatten(), np.int64) if len(lists) else np.zeros(0, np.int64), np.concatenate(([0], np.cumsum(sizes)))))
    # half an observation keeps it off 0 and 1, however rare toxic texts are
    prior = (n_pos + 0.5) / (n + 1)
    return fit(*parts, prior)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score, predicted for each row of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            value = sigmoid(own.scale * linear(word_buckets(batch.column(1)), own.weights, own.bias) + own.shift)
            columns = [batch.column(0), pa.array(value), pa.array((value >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, score double, predicted int")


def usable(rows: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32 of the id, modulo 3, is not 1."""
    return rows.where(remainder("doc_id", 3) != 1)
