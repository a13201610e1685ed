r"""Spelling variants: words one edit apart, found by pivotal grams.

Words are counted first: each task counts its own words and passes on at most
TABLE of them at a time, Spark adds up.

Two words are near if one inserted, deleted or replaced code point makes them equal.
The bigrams of a word are put in one global order, rarest first. A word's *prefix* is
its first 2 * 1 + 1 = 3 grams and all further occurrences of the last of them; its
*pivots* are two grams of the prefix that share no character, with the smallest
total frequency, chosen by dynamic programming.

Of two near words let r be the one whose prefix ends earlier in the order. One edit
harms at most one of two disjoint grams, so a pivot of r is in the other word, and
as it comes before the end of that word's prefix, it is in that prefix. The edit lies
to the right of this pivot or to the left, so

* right: gram, place from the start, and all characters before it agree;
* left: gram, place from the end, and all characters after it agree.

Pivots are therefore joined with prefixes on gram, place, the whole side and the
other word's length, which is known but for one. Candidates are verified in the join
by their edit distance and are never written. A list of the index holds only words
with a common side, and Spark splits a long one over tasks.

A word's form is its near word with the largest count (ties: the smallest in
code-point order) if that is at least FACTOR times its own. Roots follow forms by
pointer doubling; counts grow by FACTOR at each step, so there is no cycle and at
most log(count) / log(FACTOR) steps, of which each round doubles those done.

Null and empty texts have no words. A null doc_id counts as the text ``null``. Each
row counts, repeated rows too. Texts are read whole, in pieces that end between runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import small_batches, stored
from eventpulse.llm.words import slices

RUN = re.compile("[A-Za-zÀ-ÿ]{6,}")
BREAK = re.compile("[^A-Za-zÀ-ÿ]")
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
#: One run in so many, by its hash, loses a code point.
SLIP = 199
GRAM, EDITS = 2, 1
#: Characters searched at a time, and words that a task counts before it passes them on.
PIECE, TABLE = 1 << 19, 100_000


def pieces(text: str) -> Iterator[str]:
    """A text in parts of about PIECE characters that end where no run goes on."""
    at = 0
    while at < len(text):
        found = BREAK.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def slipped(run: bytes, seed: int) -> str:
    """The word that counts for a lower-cased run; seed: crc32 of what stands before it."""
    word, h = run.decode(), zlib.crc32(run, seed)
    if h % SLIP:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table: Counter[str] = Counter()

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], ["word", "n"])
        table.clear()
        return out

    for batch in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seed = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
            for piece in pieces(text or ""):
                for run, n in Counter(RUN.findall(piece)).items():
                    word = slipped(run.encode().lower(), seed)
                    if len(word) >= LEAST_LENGTH:
                        table[word] += n
                if len(table) >= TABLE:
                    yield emit()
    if table:
        yield emit()


def count_words(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words that occur at least ``least`` times in ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def prefix(grams: list[str], order: dict[str, int]) -> list[int]:
    """Places of the first GRAM * EDITS + 1 grams in the order, and of all that equal the last of them."""
    by_rank = sorted(range(len(grams)), key=lambda k: (order[grams[k]], k))
    last = order[grams[by_rank[: GRAM * EDITS + 1][-1]]]
    return sorted(k for k in by_rank if order[grams[k]] <= last)


def pivots(places: list[int], weight: list[int]) -> list[int] | None:
    """The EDITS + 1 disjoint places of least total weight; places ascend. None if there are not so many.

    best[j]: the cheapest choice of j grams among the places before the current one.
    """
    done: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * (EDITS + 1)]
    for k, at in enumerate(places):
        before = max(i for i in range(k + 1) if i == 0 or places[i - 1] + GRAM <= at)
        row = list(done[k])
        for j in range(1, EDITS + 2):
            if (base := done[before][j - 1]) is not None:
                cost = base[0] + weight[k]
                if row[j] is None or cost < row[j][0]:
                    row[j] = (cost, [*base[1], at])
        done.append(row)
    chosen = done[-1][-1]
    return chosen and chosen[1]


def _grams(word: str) -> list[str]:
    return [word[k : k + GRAM] for k in range(len(word) - GRAM + 1)]


def _frequencies(words: DataFrame) -> dict[str, int]:
    """Occurrences of each gram in the distinct words. Runs have 116 characters, so there are at most 116**2 grams."""
    places = F.sequence(F.lit(1), F.length("word") - GRAM + 1)
    grams = words.select(F.explode(F.transform(places, lambda k: F.substring("word", k, GRAM))).alias("gram"))
    return dict(grams.groupBy("gram").count().collect())


def _entries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pivots and prefix grams of all words: (key, word, last), where keys agree as the docstring tells."""
    count = _frequencies(words)
    order = {gram: k for k, gram in enumerate(sorted(count, key=lambda gram: (count[gram], gram)))}
    shared = words.sparkSession.sparkContext.broadcast((count, order))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, order = shared.value
        for batch in batches:
            out = ([], [], [], [])
            for word in batch.column(0).to_pylist():
                grams = _grams(word)
                places = prefix(grams, order)
                last, size = max(order[grams[k]] for k in places), len(word)
                chosen = pivots(places, [count[grams[k]] for k in places])
                rows = [(False, at, size) for at in places]
                rows += [(True, at, size + more) for at in chosen for more in (-1, 0, 1)]
                for pivot, at, other in rows:
                    # the parts up to and from the gram tell the gram and its place as well
                    for key in (f"{other}<{word[: at + GRAM]}", f"{other}>{word[at:]}"):
                        for column, value in zip(out, (pivot, key, word, last), strict=True):
                            column.append(value)
            kinds = (pa.bool_(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["pivot", "key", "word", "last"])

    rows = words.select("word").mapInArrow(listed, "pivot boolean, key string, word string, last int")
    rows = stored(rows.select("pivot", F.xxhash64("key").alias("key"), "word", "last"), "grams")
    return rows.where("pivot").drop("pivot"), rows.where("not pivot").drop("pivot")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: the distinct words (column word, of six code points or more) one edit apart."""
    pivot, listed = _entries(words)
    left = pivot.select("key", F.col("word").alias("r"), F.col("last").alias("r_last"))
    right = listed.select("key", F.col("word").alias("s"), F.col("last").alias("s_last"))
    near = (F.col("r_last") <= F.col("s_last")) & (F.levenshtein("r", "s", 1) == 1)
    met = left.join(right, (left.key == right.key) & near)
    return met.select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each row (word, form): the last form that following forms leads to."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        joined = now.join(ahead, "root", "left")
        now = stored(joined.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of ``docs`` (doc_id, text)."""
    words = stored(count_words(docs), "words")
    pairs = stored(near_words(words), "near")
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = ends.join(words.select(F.col("word").alias("b"), "n"), "b")
    best = F.min(F.struct((-F.col("n")).alias("less"), "b"))
    about = counted.groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(about, F.col("word") == F.col("a"), "left")
    enough = -F.col("best.less") >= FACTOR * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.b")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    found = roots(formed.where("form is not null")).select(F.col("word").alias("rooted"), "root")
    final = formed.join(found, F.col("word") == F.col("rooted"), "left")
    return final.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
