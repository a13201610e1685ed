"""Benchmark decontamination with suffix arrays over shards of the corpus.

A shard is a few MB of documents inside a task. Its words become ranks in the
benchmark's vocabulary (0 for all others, and between documents). The suffix array
holds the suffixes that begin with a word pair of the benchmark, or with a word that
is a whole item; no other suffix can hold a passage. Every suffix of every
benchmark item is looked up by binary search: its neighbours in the array give the
longest verbatim match and its place, the interval of its first ``WINDOW`` words
gives all occurrences of that window. Nothing is shuffled.

The benchmark is the stated query set: it is broadcast in blocks of BLOCK_WORDS
words. A pass over the documents searches at most PASS_WORDS of them, so a task's
memory is bounded whatever the benchmark; a larger one takes several passes, each of
which carries on the hit words, items and matches of those before.

Null or empty texts have no words; such documents are clean and such items have no
window. Items with a null id mark words, but are not named. An item_id with several
texts has the windows of all. Each row of ``docs`` gives one row, null doc_id too.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import small_batches, stored, text_column
from eventpulse.llm.words import ALNUM, slices, words_of

WINDOW = 10
SHARD_BYTES = 1 << 20
BLOCK_WORDS = 1 << 20
#: About 60 bytes a word in each Python worker.
PASS_WORDS = 1 << 21
STEP = 16


class Block(NamedTuple):
    """Part of the benchmark; words are ranks from 1 in ``vocabulary``, items end with a 0."""

    vocabulary: np.ndarray  # sorted word hashes
    words: np.ndarray
    suffixes: np.ndarray  # first word of every suffix
    left: np.ndarray  # words from there to the item's end
    item: np.ndarray  # item of every suffix
    windows: np.ndarray  # suffixes that begin a window, by number
    width: np.ndarray  # words of each window
    pairs: np.ndarray  # sorted keys of adjacent words
    single: np.ndarray  # by rank: is the word a whole item
    names: list[str | None]
    first: np.ndarray  # by rank: an item that holds the word


def block_of(rows: list[tuple[str | None, np.ndarray]]) -> Block:
    vocabulary = np.unique(np.concatenate([h for _, h in rows]))
    single = np.zeros(len(vocabulary) + 1, bool)
    words, suffixes, left, item, windows, width = [], [], [], [], [], []
    at = done = 0
    for number, (_, hashes) in enumerate(rows):
        n, own = len(hashes), np.searchsorted(vocabulary, hashes) + 1
        words.append(np.append(own, 0))
        suffixes.append(at + np.arange(n))
        left.append(n - np.arange(n))
        item.append(np.full(n, number))
        w = min(WINDOW, n)
        windows.append(done + np.arange(n - w + 1))
        width.append(np.full(n - w + 1, w))
        if n == 1:
            single[own] = True
        at, done = at + n + 1, done + n
    words = np.concatenate(words).astype(np.int64)
    key = words[:-1] * (len(vocabulary) + 1) + words[1:]
    pairs = np.unique(key[(words[:-1] > 0) & (words[1:] > 0)])
    join = np.concatenate
    suffixes, item = join(suffixes), join(item)
    first = np.zeros(len(vocabulary) + 1, np.int64)
    first[words[suffixes][::-1]] = item[::-1]
    return Block(vocabulary, words, suffixes, join(left), item, join(windows), join(width), pairs, single, [n for n, _ in rows], first)


def member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def suffix_array(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``depth`` words."""
    group = np.zeros(len(at), np.int64)
    done = 0
    tied = np.arange(len(at))
    while done < depth and len(tied):
        cells = text[np.minimum(at[tied][:, None] + np.arange(done, done + STEP), len(text) - 1)]
        order = np.lexsort((*cells.T[::-1], group[tied]))
        new = np.ones(len(tied), bool)
        new[1:] = (np.diff(group[tied][order]) != 0) | (cells[order][1:] != cells[order][:-1]).any(axis=1)
        at[tied] = at[tied][order]
        number = np.cumsum(new)
        group[tied] = tied[np.flatnonzero(new)][number - 1]
        size = np.bincount(number)[number]
        tied, done = tied[size > 1], done + STEP
    return at


def compare(text: np.ndarray, at: np.ndarray, block: Block, suffix: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common words of text suffixes and item suffixes, up to ``most``; and the sign of text - item after them."""
    same, sign = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    begin = block.suffixes[suffix]
    live = np.flatnonzero(most > 0)
    while len(live):
        off = same[live][:, None] + np.arange(STEP)
        a = text[np.minimum(at[live][:, None] + off, len(text) - 1)]
        b = block.words[np.minimum(begin[live][:, None] + off, len(block.words) - 1)]
        differ = (a != b) | (off >= most[live][:, None])
        any_ = differ.any(axis=1)
        first = np.where(any_, differ.argmax(axis=1), STEP)
        same[live] += first
        row = np.flatnonzero(any_)
        delta = np.sign(a[row, first[row]] - b[row, first[row]])
        sign[live[row]] = np.where(same[live[row]] >= most[live[row]], 0, delta)
        live = live[~any_]
    return same, sign


def bound(text: np.ndarray, array: np.ndarray, block: Block, suffix: np.ndarray, most: np.ndarray, upper: bool) -> np.ndarray:
    """First place in the suffix array at or (upper) after all suffixes that begin with the item's words."""
    lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(array), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        _, sign = compare(text, array[mid], block, suffix[open_], most[open_])
        right = sign <= 0 if upper else sign < 0
        lo[open_], hi[open_] = np.where(right, mid + 1, lo[open_]), np.where(right, hi[open_], mid)
    return lo


class Shard:
    """Hit words, items and longest match of the documents of one shard."""

    def __init__(self, column: pa.Array) -> None:
        words = words_of(column, ALNUM, lower=True)
        self.n_words = np.diff(words.bounds)
        rows = len(self.n_words)
        self.hashes = words.hashes
        self.place = np.arange(len(words.hashes)) + np.repeat(np.arange(rows), self.n_words)
        self.begin = words.bounds[:-1] + np.arange(rows)
        self.hit = np.zeros(len(words.hashes) + rows + 1, bool)
        self.items: list[set[str]] = [set() for _ in range(rows)]
        self.longest = [(0, None, None)] * rows

    def search(self, block: Block) -> None:
        at, known = member(self.hashes, block.vocabulary)
        text = np.zeros(len(self.hit) + 1, np.int64)
        text[self.place] = np.where(known, at + 1, 0)
        self._one_word(text, block)
        both = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
        key = text[both] * (len(block.vocabulary) + 1) + text[both + 1]
        starts = np.union1d(both[member(key, block.pairs)[1]], np.flatnonzero(block.single[text]))
        if not len(starts):
            return
        # of the test suffixes, only those whose first pair (or single word) is in the shard can match
        first = block.words[block.suffixes]
        head = first * (len(block.vocabulary) + 1) + block.words[block.suffixes + 1]
        there = member(head, np.unique(key))[1] | block.single[first]
        array = suffix_array(text, starts, int(block.left.max()))
        suffix = np.flatnonzero(there)
        self._longest(text, array, block, suffix)
        chosen = there[block.windows]
        suffix, width = block.windows[chosen], block.width[chosen]
        low, high = (bound(text, array, block, suffix, width, upper) for upper in (False, True))
        found = np.repeat(np.arange(len(suffix)), high - low)
        inside = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        spot = array[low[found] + inside]
        mark = np.zeros(len(self.hit) + WINDOW + 1, np.int64)
        np.add.at(mark, spot, 1)
        np.add.at(mark, spot + width[found], -1)
        self.hit |= np.cumsum(mark)[: len(self.hit)] > 0
        doc = np.searchsorted(self.begin, spot, side="right") - 1
        for row, number in np.unique(np.stack((doc, block.item[suffix[found]])), axis=1).T.tolist() if len(found) else ():
            if block.names[number] is not None:
                self.items[row].add(block.names[number])

    def _one_word(self, text: np.ndarray, block: Block) -> None:
        """A document's first known word is a match of one word; longer ones come from the suffix array."""
        found = np.flatnonzero(text)
        doc, at = np.unique(np.searchsorted(self.begin, found, side="right") - 1, return_index=True)
        for row, spot in zip(doc.tolist(), found[at].tolist(), strict=True):
            if not self.longest[row][0]:
                self.longest[row] = (1, block.names[int(block.first[text[spot]])], spot - int(self.begin[row]))

    def carry(self, hits: list[list[int]], items: list[list[str]], longest: list[tuple]) -> None:
        """Take over what an earlier pass found in the same documents."""
        for row, ends in enumerate(hits):
            for lo, hi in zip(ends[::2], ends[1::2], strict=True):
                self.hit[self.begin[row] + lo : self.begin[row] + hi] = True
        self.items = [set(own) for own in items]
        self.longest = longest

    def spans(self) -> list[list[int]]:
        """Bounds of the runs of hit words of each document."""
        out = []
        for begin, n in zip(self.begin.tolist(), self.n_words.tolist(), strict=True):
            step = np.diff(self.hit[begin : begin + n].astype(np.int8), prepend=0, append=0)
            out.append(np.flatnonzero(step).tolist())
        return out

    def _longest(self, text: np.ndarray, array: np.ndarray, block: Block, suffix: np.ndarray) -> None:
        """The longest match of each test suffix stands next to it; keep the best of each document."""
        low = bound(text, array, block, suffix, block.left[suffix], False)
        for near in (low - 1, low):
            fits = np.flatnonzero((near >= 0) & (near < len(array)))
            spot = array[near[fits]]
            same, _ = compare(text, spot, block, suffix[fits], block.left[suffix[fits]])
            doc = np.searchsorted(self.begin, spot, side="right") - 1
            order = np.lexsort((spot, -same, doc))
            best = order[np.unique(doc[order], return_index=True)[1]]
            for k in best.tolist():
                row, n = int(doc[k]), int(same[k])
                if n > self.longest[row][0]:
                    name = block.names[int(block.item[suffix[fits[k]]])]
                    self.longest[row] = (n, name, int(spot[k] - self.begin[row]))

    def hits(self) -> list[int]:
        total = np.concatenate(([0], np.cumsum(self.hit)))
        return (total[self.begin + self.n_words] - total[self.begin]).tolist()


def _passes(benchmark: DataFrame) -> Iterator[list[Block]]:
    """The benchmark in blocks, streamed to the driver; as many at a time as one pass searches."""
    blocks, rows, size, total = [], [], 0, 0
    for name, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        hashes = words_of(pa.array([text], pa.string()), ALNUM, lower=True).hashes
        if not len(hashes):
            continue
        rows.append((name, hashes))
        size, total = size + len(hashes), total + len(hashes)
        if size >= min(BLOCK_WORDS, PASS_WORDS):
            blocks.append(block_of(rows))
            rows, size = [], 0
        if total >= PASS_WORDS and blocks and not rows:
            yield blocks
            blocks, total = [], 0
    blocks += [block_of(rows)] if rows else []
    if blocks:
        yield blocks


OUT = "doc_id long, n_words long, n_hit long, items array<string>, longest long, longest_item string, longest_at long"


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (names, sorted), longest, longest_item, longest_at for each row of ``docs``.

    The last three are the longest match found at any test suffix: its words, item and first word.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for blocks in _passes(benchmark):
        if found is not None:
            found = stored(found, "passes")
        found = _searched(rows if found is None else found, [context.broadcast(block) for block in blocks], found is not None)
    found = _searched(rows, [], False) if found is None else found
    return found.select("doc_id", "n_words", "n_hit", "items", "longest", "longest_item", "longest_at")


def _searched(rows: DataFrame, blocks: list, again: bool) -> DataFrame:
    """One pass: the documents with what these blocks, and the passes before, find in them."""
    names = ["doc_id", "text", "n_words", "n_hit", "items", "longest", "longest_item", "longest_at", "hits"]
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, most=SHARD_BYTES):
            shard = Shard(batch.column(1))
            if again:
                longest = zip(*(batch.column(k).to_pylist() for k in (5, 6, 7)), strict=True)
                shard.carry(batch.column(8).to_pylist(), batch.column(4).to_pylist(), list(longest))
            for block in blocks:
                shard.search(block.value)
            items = [sorted(own, key=str.encode) for own in shard.items]
            own = (shard.n_words, shard.hits(), items, *zip(*shard.longest, strict=True), shard.spans())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(own, kinds, strict=True))], names)

    return rows.mapInArrow(search, OUT.replace("doc_id long", "doc_id long, text string") + ", hits array<long>")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns as they were.

    Each row is judged by its own text, in place, so its doc_id may be null or repeated and no text is shuffled.
    """
    small_batches(docs.sparkSession)
    at = text_column(docs)
    for number, blocks in enumerate(_passes(benchmark)):
        docs = _without(stored(docs, "passes") if number else docs, [docs.sparkSession.sparkContext.broadcast(block) for block in blocks], at)
    return docs


def _without(docs: DataFrame, blocks: list, at: int) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, most=SHARD_BYTES):
            shard = Shard(batch.column(at))
            for block in blocks:
                shard.search(block.value)
            yield batch.filter(pa.array([n == 0 for n in shard.hits()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
