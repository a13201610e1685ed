"""Language ID with a bit-sliced Bloom filter whose slots hold language bitmasks.

Learning counts byte 4-grams of lower-cased letters on at most FIT_ROWS labelled
texts per language (chosen by a hash of doc_id, whole texts). A language keeps a
gram that it uses at least MIN_COUNT times (as many less as it has few grams: below
RARE, once is enough) and RATIO as often as the language that uses it most. Every slot of the filter is one bit for each language, 64 to a word:
the AND of a gram's HASHES slots is the set of all languages that may contain it.

A text's popcount per language counts its grams with that bit. A language whose
slots are filled to a share f gets a false hit with f**HASHES; the counts are
corrected by that, and the largest wins (ties: the smallest language). The score is
the winner's part of the two largest counts.

``und`` with score 0 is given to null texts, texts without a letter, and to all if
nothing was learned. Null languages are not learned from; rows with a null doc_id
neither. A repeated doc_id counts with each row. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import only, remainder, small_batches, stored, text_column
from eventpulse.llm.words import mix, slices

GRAM = 4
FIT_ROWS = 3000
MIN_COUNT = 5
#: Grams of a language that raise its least count by one, up to MIN_COUNT.
RARE = 20_000
RATIO = 0.25
HASHES = 2
SLOTS_PER_GRAM = 16
#: A text with a smaller corrected share of its grams in the winning language is in none of them.
KNOWN = 0.2
LETTER = re.compile(r"[^\W\d_]")
GAP = np.frombuffer(b" " * GRAM, np.uint8)
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x80:] = np.arange(0x80, 256)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


class Filter(NamedTuple):
    languages: list[str]
    slots: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray  # by language


def has_letter(text: str | None) -> bool:
    found = LETTER.search(text or "")
    return bool(found) and (found[0].isalpha() or any(map(str.isalpha, text)))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """4-grams of all texts as 32-bit numbers, and where each text's begin and end."""
    raw = [(text or "").lower().encode(errors="replace") for text in texts]
    data = _LETTERS[np.frombuffer(b" " * GRAM + (b" " * GRAM).join(raw) + b" " * GRAM, np.uint8)]
    offsets = np.concatenate(([0], np.cumsum([len(x) + GRAM for x in raw])))
    space = data == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    # runs of blanks shrink to one, so a gram spans at most one gap
    at = np.cumsum(keep)
    data = data[keep].astype(np.uint32)
    all_ = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24 if len(data) >= GRAM else np.zeros(0, np.uint32)
    bounds = np.minimum(at[np.minimum(offsets, len(at) - 1)] - 1, len(all_))
    # the last grams of a text would reach into the next one
    own = np.ones(len(all_), bool)
    for k in range(1, GRAM - 1):
        cut = bounds[1:-1] - k
        own[cut[(cut >= 0) & (cut >= bounds[:-2])]] = False
    total = np.concatenate(([0], np.cumsum(own)))
    return all_[own], total[bounds]


def places(gram: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(gram.astype(np.uint64) + np.uint64(0x51ED27))
    return [((h >> np.uint64(32 * k)) & np.uint64(slots - 1)).astype(np.int64) for k in range(HASHES)]


def build(languages: list[str], gram: np.ndarray, language: np.ndarray) -> Filter:
    slots = 1 << max(10, int(len(gram) * SLOTS_PER_GRAM - 1).bit_length())
    table = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
    bit = np.uint64(1) << (language % 64).astype(np.uint64)
    for at in places(gram, slots):
        np.bitwise_or.at(table, (at, language // 64), bit)
    fill = [float((table[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean()) for k in range(len(languages))]
    return Filter(languages, table, np.asarray(fill) ** HASHES)


def counts(own: Filter, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected popcounts, texts x languages, and the number of grams of each text."""
    gram, bounds = grams(texts)
    first, *more = places(gram, len(own.slots))
    mask = own.slots[first]
    for at in more:
        mask &= own.slots[at]
    n = np.diff(bounds)
    hits = np.empty((len(texts), len(own.languages)))
    for k in range(len(own.languages)):
        total = np.concatenate(([0], np.cumsum(mask[:, k // 64] >> np.uint64(k % 64) & np.uint64(1), dtype=np.int64)))
        hits[:, k] = np.diff(total[bounds])
    return np.maximum(0.0, (hits - n[:, None] * own.false_rate) / (1 - own.false_rate)), n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs = np.asarray(batch.column(2).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            gram, _ = grams([texts[k] for k in np.flatnonzero(langs == lang)])
            value, n = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value), pa.string()), pa.array(value.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Filter:
    """The filter from labelled rows (doc_id, text, lang); at most ``fit_rows`` of each language."""
    small_batches(docs.sparkSession)
    rows = docs.where("doc_id is not null and lang is not null and text is not null")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    ids = rows.select("doc_id", "lang")
    sizes = stored(ids.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    # hashes are uniform: of twice as many rows as are wanted, half are surely enough, so a group to rank is small
    place = F.xxhash64("doc_id") / 2.0**64 + 0.5
    few = ids.join(sizes, "lang").where(place * F.col("rows") <= 2 * fit_rows)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= fit_rows)
    chosen = stored(chosen.select("doc_id", "lang").distinct(), "fit")
    texts = only(rows.select("doc_id", "text"), chosen.select("doc_id")).join(chosen, "doc_id").select("doc_id", "text", "lang")
    used = texts.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    used = stored(used, "grams")
    share = used.join(used.groupBy("lang").agg(F.sum("n").alias("all")), "lang").withColumn("f", F.col("n") / F.col("all"))
    top = share.groupBy("gram").agg(F.max("f").alias("top"))
    kept = share.where(F.col("n") >= F.least(F.lit(MIN_COUNT), 1 + F.floor(F.col("all") / RARE))).join(top, "gram").where(F.col("f") >= RATIO * F.col("top")).select("gram", "lang").toArrow()
    languages = sorted({r[0] for r in chosen.select("lang").distinct().collect()}, key=str.encode)
    number = {lang: k for k, lang in enumerate(languages)}
    language = np.asarray([number[x] for x in kept["lang"].to_pylist()], np.int64)
    return build(languages, kept["gram"].to_numpy().astype(np.uint32), language)


def _judged(own: Filter, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, share of grams that the language holds and number of grams, for each text."""
    if not own.languages:
        return ["und"] * len(texts), *(np.zeros(len(texts)) for _ in range(3))
    hits, n = counts(own, texts)
    best = hits.argmax(axis=1)
    first = hits[np.arange(len(texts)), best]
    second = np.partition(hits, -2, axis=1)[:, -2] if hits.shape[1] > 1 else np.zeros(len(texts))
    letters = np.asarray([has_letter(text) for text in texts], bool)
    lang = [own.languages[k] if some else "und" for k, some in zip(best, letters, strict=True)]
    score = np.where(letters & (first > 0), first / np.maximum(first + second, 1e-12), 0.0)
    return lang, score, np.where(letters, np.minimum(1.0, first / np.maximum(n, 1)), 0.0), n


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, lang_pred, score, known (share of grams that the winner holds) for each row of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            lang, score, known, _ = _judged(own, batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(known)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "known"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, lang_pred string, score double, known double")


def training(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32 of the id, modulo 4, is not 2."""
    return docs.where(remainder("doc_id", 4) != 2)


def spoken(docs: DataFrame, known: float = KNOWN) -> DataFrame:
    """The rows of ``docs`` written in a learned language, all columns as they were.

    Each row is judged by its own text, in place, so no text is shuffled. It goes if
    it is ``und`` or its share of known grams is below ``known`` by more than the largest
    standard deviation of a share among so many grams, since a short text tells little;
    a quarter of ``known`` is needed in any case.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(training(docs)))
    at = text_column(docs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, at):
            lang, _, share, n = _judged(own, batch.column(at).to_pylist())
            stay = (np.asarray(lang, object) != "und") & (share >= np.maximum(known / 4, known - 0.5 / np.sqrt(np.maximum(n, 1))))
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
