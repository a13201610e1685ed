"""Hard-negative mining: exact integer scores of anchor-candidate tiles by Strassen's recursion.

A component x becomes floor(256 x). The score of two rows is the integer inner
product of their vectors. Anchors and candidates are dealt to blocks by a hash of
vec_id, and a tile is one block of each:

1. Blocks of anchors meet the blocks of candidates with the same label. A tile
   keeps each anchor's ``positives`` best partners as a heap (a sorted list of
   bounded length). Heaps merge: the best of two heaps are the best of all rows
   behind them. So Spark keeps the best rows per anchor in every task, before the
   shuffle, and once more after it.
2. Each positive p opens a window: scores n of other labels with
   50 p <= 100 n <= 95 p. Blocks of anchors, with their windows, meet all blocks of
   candidates, and a tile keeps the best ``negatives`` rows of each window as a heap,
   merged in the same way.

A tile is multiplied in pieces of PIECE rows by PIECE rows, so it needs the memory
of its vectors and of one piece. Pieces are padded with zeros to even sizes at each
level of the recursion, and seven products of half the size replace eight until
LEAF. Sums and differences are those of 64-bit integers, which are exact modulo
2**64, so the score is exact if it fits 64 bits. Pieces in which it may not fit are
multiplied with Python integers, and scores are cut to the bounds of a long.

Every anchor meets every row, in blocks, as the task states; nothing is sampled.

Rows with a null vec_id, label or vector, or a null or non-finite component take no
part. Of rows with the same vec_id the smallest by label, then vector, takes part.
Vectors of different lengths are compared as if padded with zeros; an empty vector
scores 0. Ties go to the smaller vec_id. An anchor without positives, or a positive
whose window is empty, returns no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import stored

#: Rows of a block of anchors and of candidates, and of a piece that is multiplied at once.
ANCHORS, CANDIDATES, PIECE = 2048, 4096, 512
#: Size at which the recursion multiplies directly.
LEAF = 32
#: Share of a positive's score that a negative must and may reach, in hundredths.
LEAST, MOST = 50, 95
#: Sums of products below this in absolute value surely fit 64 bits.
SAFE = 2**62
HEAP = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
LONG = 2**63 - 1


def padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """x with zeros below and to the right."""
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), x.dtype)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The matrix product of integers: seven products of half the size, recursively."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    hm, hk, hn = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = padded(a, 2 * hm, 2 * hk), padded(b, 2 * hk, 2 * hn)
    a11, a12, a21, a22 = a[:hm, :hk], a[:hm, hk:], a[hm:, :hk], a[hm:, hk:]
    b11, b12, b21, b22 = b[:hk, :hn], b[:hk, hn:], b[hk:, :hn], b[hk:, hn:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    out = np.empty((2 * hm, 2 * hn), p1.dtype)
    out[:hm, hn:] = p3 + p5
    out[hm:, :hn] = p2 + p4
    out[hm:, hn:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12, leaf)
    out[:hm, :hn] = p1 + p4 - p5 + strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def quantised(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """floor(256 x) of all vectors, padded with zeros; Python integers if one doesn't fit 64 bits."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64)
    wide = bool(len(flat)) and float(np.abs(flat).max()) >= 2.0**54
    # 256 x is x with another exponent, hence exact; from 2**54 on x is an integer itself
    if wide:
        values = np.array([int(x) * 256 if abs(x) >= 2.0**54 else math.floor(x * 256) for x in flat.tolist()], object)
    else:
        values = np.floor(flat * 256.0).astype(np.int64)
    out = np.zeros((len(size), max(1, int(size.max(initial=0)))), values.dtype)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b as 64-bit integers, cut to their bounds."""
    width = max(a.shape[1], b.shape[1])
    a, b = padded(a, len(a), width), padded(b, len(b), width)
    peak = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * width
    if peak < SAFE:
        return strassen(a.astype(np.int64, copy=False), b.T.astype(np.int64, copy=False))
    exact = strassen(a.astype(object), b.T.astype(object))
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def window_of(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest negative score n with LEAST p <= 100 n <= MOST p, without products that overflow."""
    whole, rest = score // 100, score % 100
    return LEAST * whole - (-LEAST * rest // 100), MOST * whole + MOST * rest // 100


def best(score: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` largest allowed entries of each row; ties: the first column."""
    left = allowed.copy()
    rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _ in range(most):
        some = np.flatnonzero(left.any(axis=1))
        if not len(some):
            break
        at = np.where(left[some], score[some], -LONG - 1).argmax(axis=1)
        # the least long may be a score itself
        lost = np.flatnonzero(~left[some, at])
        at[lost] = left[some[lost]].argmax(axis=1)
        rows.append(some)
        columns.append(at)
        left[some, at] = False
    return np.concatenate(rows), np.concatenate(columns)


def merged(found: list[tuple[np.ndarray, ...]], most: int) -> list[np.ndarray]:
    """Heaps of several pieces as one: rows of (owner..., score, other), the best ``most`` of each owner."""
    *owner, score, other = (np.concatenate(column) for column in zip(*found, strict=True))
    # ~x falls as x rises, and has no overflow
    order = np.lexsort((other, ~score, *owner[::-1]))
    columns = [column[order] for column in (*owner, score, other)]
    new = np.ones(len(order), bool)
    new[1:] = np.any([column[1:] != column[:-1] for column in columns[:-2]], axis=0)
    first = np.flatnonzero(new)
    place = np.arange(len(order)) - first[np.cumsum(new) - 1] if len(order) else order
    return [column[place < most] for column in columns]


def top(heaps: DataFrame, by: list[str], score: str, other: str, most: int, rank: str) -> DataFrame:
    """Heaps merged: the ``most`` best rows by ``by``; Spark cuts to them before and after its shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), other)
    return heaps.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= most)


def _pieces(n: int) -> Iterator[slice]:
    return (slice(k, k + PIECE) for k in range(0, n, PIECE))


def _split(tile: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Anchors and candidates of a tile, each by vec_id."""
    side = tile["side"].to_numpy()
    ids = tile["vec_id"].to_numpy()
    parts = (np.flatnonzero(side == s) for s in (0, 1))
    return tuple(tile.take(pa.array(own[np.argsort(ids[own], kind="stable")])) for own in parts)


def positive_tile(most: int) -> Callable[[pa.Table], pa.Table]:
    def mine(tile: pa.Table) -> pa.Table:
        anchors, others = _split(tile)
        a, b = quantised(anchors["v"]), quantised(others["v"])
        ids, own = others["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
        heaps = [(np.zeros(0, np.int64),) * 3]
        for x in _pieces(len(a)):
            found = heaps[:1]
            for y in _pieces(len(b)):
                score = scores(a[x], b[y])
                i, j = best(score, own[x][:, None] != ids[y][None, :], most)
                found.append((own[x][i], score[i, j], ids[y][j]))
                found = [merged(found, most)]
            heaps += found
        columns = [np.concatenate(c) for c in zip(*heaps, strict=True)]
        return pa.table(dict(zip(("anchor_id", "positive_score", "positive_id"), columns, strict=True))).select(HEAP[:3])

    return mine


def negative_tile(most: int) -> Callable[[pa.Table], pa.Table]:
    def mine(tile: pa.Table) -> pa.Table:
        anchors, others = _split(tile)
        a, b = quantised(anchors["v"]), quantised(others["v"])
        own, ids = anchors["vec_id"].to_numpy(), others["vec_id"].to_numpy()
        # labels as numbers, whatever their type
        label = pa.concat_arrays([*anchors["label"].chunks, *others["label"].chunks]).dictionary_encode().indices.to_numpy()
        left, right = label[: len(own)], label[len(own) :]
        lists = anchors["positives"].to_pylist()
        depth = max(map(len, lists), default=0)
        heaps = [(np.zeros(0, np.int64),) * 5]
        for x in _pieces(len(a)):
            found = heaps[:1]
            for y in _pieces(len(b)):
                score = scores(a[x], b[y])
                other = left[x][:, None] != right[y][None, :]
                for k in range(depth):
                    has = np.flatnonzero([len(p) > k for p in lists[x]])
                    p = np.array([lists[x][r][k]["positive_score"] for r in has], np.int64)
                    low, high = window_of(p)
                    part = score[has]
                    i, j = best(part, other[has] & (part >= low[:, None]) & (part <= high[:, None]), most)
                    which = np.array([lists[x][r][k]["positive_id"] for r in has], np.int64)
                    found.append((own[x][has[i]], which[i], p[i], part[i, j], ids[y][j]))
                found = [merged(found, most)]
            heaps += found
        columns = [np.concatenate(c) for c in zip(*heaps, strict=True)]
        names = ("anchor_id", "positive_id", "positive_score", "negative_score", "negative_id")
        return pa.table(dict(zip(names, columns, strict=True))).select(HEAP)

    return mine


def _usable() -> Column:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad


def _block(blocks: Column | str, seed: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", F.lit(seed)), blocks).cast("int")


def _each(blocks: Column | int) -> Column:
    last = blocks if isinstance(blocks, Column) else F.lit(blocks)
    return F.explode(F.sequence(F.lit(0), last.cast("int") - 1))


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are (vec_id, label, embedding); ``anchor`` is a condition on vec_id.
    """
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("v"))
    unique = named.where(_usable()).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    own = stored(unique.select("vec_id", "r.label", "r.v", F.coalesce(anchor, F.lit(False)).alias("anchor")), "vectors")
    head = own.where("anchor").select("vec_id", "label", "v")
    per_label = own.groupBy("label").agg(
        F.ceil(F.count_if("anchor") / ANCHORS).alias("a_blocks"), F.ceil(F.count("*") / CANDIDATES).alias("c_blocks")
    )
    per_label = stored(per_label.where("a_blocks > 0"), "labels")

    sized = head.join(per_label, "label").withColumns({"i": _block("a_blocks", 1), "j": _each(F.col("c_blocks")), "side": F.lit(0)})
    other = own.join(per_label, "label").withColumns({"i": _each(F.col("a_blocks")), "j": _block("c_blocks", 2), "side": F.lit(1)})
    columns = ["label", "i", "j", "side", "vec_id", "v"]
    tiles = sized.select(columns).unionByName(other.select(columns)).groupBy("label", "i", "j")
    heaps = tiles.applyInArrow(positive_tile(positives), "anchor_id long, positive_id long, positive_score long")
    near = stored(top(heaps, ["anchor_id"], "positive_score", "positive_id", positives, "place"), "positives")

    lists = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    lists = stored(head.join(lists, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "v", "positives"), "windows")
    n_anchors, n_rows = lists.count(), own.count()
    a_blocks, c_blocks = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    kind = lists.schema["positives"].dataType
    asked = lists.withColumns({"i": _block(F.lit(a_blocks), 3), "j": _each(c_blocks), "side": F.lit(0)})
    given = own.withColumns({"i": _each(a_blocks), "j": _block(F.lit(c_blocks), 4), "side": F.lit(1), "positives": F.lit(None).cast(kind)})
    columns = ["i", "j", "side", "vec_id", "label", "v", "positives"]
    tiles = asked.select(columns).unionByName(given.select(columns)).groupBy("i", "j")
    heaps = tiles.applyInArrow(
        negative_tile(negatives), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    found = top(heaps, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
