"""Embedding near-dedup: PCA-ordered tiled comparison.

Only vectors of the same label and length are compared. Equal vectors form a class
first. The moments of all vectors give a PCA basis; in it

* vectors are sorted by the Z-order of their ORDER leading coordinates and cut into
  blocks of at most BLOCK; a block is one row, with the range of its LEAD leading
  coordinates;
* unit vectors of cosine c are sqrt(2 - 2c) apart, so two blocks can hold a pair only
  if the gaps between their ranges are no longer than that together. Ranges alone are
  joined, by cells of the two first coordinates, before any vector moves; a block then
  goes to its few neighbours, whatever the size of its label;
* a tile compares two blocks. It adds up products of leading dimensions first and drops
  a pair as soon as the sum plus the product of the norms of what is left can't reach
  the bound. What survives is decided by the cosine of the vectors as given.

A tile returns link counts and a spanning forest of its links, not the pairs, so a
group of copies adds rows in proportion to its size.

Null labels, null, empty or zero vectors and vectors with null or non-finite
components link with nothing; so do rows with a null vec_id (component null,
kept). Each row counts as a vector; rows with the same vec_id share a component.
Classes are named by 128 bits of two hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import components, small_batches, stored

BLOCK = 1024
STEP = 8
#: Leading coordinates that order vectors, with BITS bits each, and that bound a block.
ORDER, BITS, LEAD = 4, 8, 8
#: Room for rounding in bounds that only drop pairs.
SLACK = 1e-9


def _valid() -> Column:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrices(batch: pa.RecordBatch | pa.Table, name: str = "embedding") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each length."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)].astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length: the number, sum and sum of outer products of unit vectors."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, vectors in _matrices(batch):
            unit = _unit(vectors)
            own = np.concatenate(([len(unit)], unit.sum(axis=0), (unit.T @ unit).ravel()))
            d = unit.shape[1]
            total[d] = total[d] + own if d in total else own
    columns = [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(columns, ["dim", "moments"])


def _bases(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length the principal directions as columns, largest variance first.

    The tasks' moments are added up place by place; the driver gets one sum for each
    pair of dimensions.
    """
    own = vectors.mapInArrow(_moments, "dim int, moments array<double>").select("dim", F.posexplode("moments").alias("place", "value"))
    sums = own.groupBy("dim", "place").agg(F.sum("value").alias("value")).toArrow()
    dims, places, values = (sums[name].to_numpy() for name in ("dim", "place", "value"))
    bases = {}
    for d in np.unique(dims).tolist():
        own = np.zeros(1 + d + d * d)
        own[places[dims == d]] = values[dims == d]
        mean = own[1 : d + 1] / own[0]
        spread = own[d + 1 :].reshape(d, d) / own[0] - np.outer(mean, mean)
        bases[d] = np.linalg.eigh(spread)[1][:, ::-1].copy()
    return bases


def curve_place(lead: np.ndarray) -> np.ndarray:
    """Z-order of coordinates from -1 to 1: their bits, interleaved from the highest on."""
    cell = np.clip(((lead[:, :ORDER] + 1) * (1 << (BITS - 1))).astype(np.int64), 0, (1 << BITS) - 1)
    place = np.zeros(len(lead), np.int64)
    for bit in reversed(range(BITS)):
        for k in range(cell.shape[1]):
            place = place << 1 | cell[:, k] >> bit & 1
    return place


def compare_tile(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose cosine reaches the threshold; ``same``: a is b, each pair once."""
    ua, ub = _unit(a), _unit(b)
    ra, rb = ua @ basis, ub @ basis
    d = ra.shape[1]
    left_a = np.sqrt(np.maximum(np.cumsum((ra * ra)[:, ::-1], axis=1)[:, ::-1], 0))
    left_b = np.sqrt(np.maximum(np.cumsum((rb * rb)[:, ::-1], axis=1)[:, ::-1], 0))
    at = min(STEP, d)
    part = ra[:, :at] @ rb[:, :at].T
    rest = np.outer(left_a[:, at], left_b[:, at]) if at < d else 0.0
    open_ = part + rest >= threshold - SLACK
    if same:
        open_ = np.triu(open_, 1)
    i, j = np.nonzero(open_)
    sums = part[i, j]
    while at < d and len(i):
        end = min(2 * at, d)
        sums = sums + np.einsum("nd,nd->n", ra[i, at:end], rb[j, at:end])
        at = end
        rest = left_a[i, at] * left_b[j, at] if at < d else 0.0
        live = sums + rest >= threshold - SLACK
        i, j, sums = i[live], j[live], sums[live]
    exact = np.einsum("nd,nd->n", a[i], b[j]) / np.sqrt((a[i] * a[i]).sum(axis=1) * (b[j] * b[j]).sum(axis=1)) if len(i) else sums
    exact = np.where(np.isfinite(exact), exact, np.einsum("nd,nd->n", ua[i], ub[j]))
    live = exact >= threshold
    return i[live], j[live]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _blocks(classes: DataFrame, bases) -> DataFrame:
    """(block, label, dim, low, high, cls, copies, data): up to BLOCK neighbouring classes a row, stored."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, at = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for own, vectors in _matrices(batch):
                dim[own] = vectors.shape[1]
                at[own] = curve_place(_unit(vectors) @ bases.value[vectors.shape[1]][:, :ORDER])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dim), pa.array(at)], [*batch.schema.names, "dim", "place"])

    kind = classes.schema["embedding"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    rows = classes.select("cls", "copies", "label", "embedding")
    placed = stored(rows.mapInArrow(place, f"cls string, copies long, label {label}, embedding {kind}, dim int, place long"), "placed")
    order = ["label", "dim", "place", "cls"]
    tasks = max(1, -(-placed.count() // (8 * BLOCK)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, open_ = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            open_ = part if open_ is None else pa.concat_tables([open_, part])
            # a block ends at BLOCK rows, or where the label or the length changes
            key = open_.select(["label", "dim"]).combine_chunks()
            codes = [key[name].combine_chunks().dictionary_encode().indices.to_numpy() if len(key) else np.zeros(0) for name in ("label", "dim")]
            change = np.flatnonzero((np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0)) + 1
            bounds = [0, *change.tolist(), len(open_)]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                whole = hi < len(open_)
                while hi - lo >= BLOCK or (whole and lo < hi):
                    yield packed(open_.slice(lo, min(BLOCK, hi - lo)), first + done)
                    lo, done = min(hi, lo + BLOCK), done + 1
            open_ = open_.slice(lo)
        if open_ is not None and len(open_):
            yield packed(open_, first + done)

    def packed(rows: pa.Table, number: int) -> pa.RecordBatch:
        [(_, vectors)] = _matrices(rows)
        lead = _unit(vectors) @ bases.value[vectors.shape[1]][:, :LEAD]
        lists = [rows["cls"].to_pylist(), rows["copies"].to_pylist(), rows["embedding"].combine_chunks().flatten()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), rows["label"].combine_chunks().slice(0, 1), rows["dim"].combine_chunks().slice(0, 1),
                pa.array([lead.min(axis=0)]), pa.array([lead.max(axis=0)]), pa.array([lists[0]]), pa.array([lists[1]]),
                pa.ListArray.from_arrays(pa.array([0, len(lists[2])], pa.int32()), lists[2]),
            ],
            ["block", "label", "dim", "low", "high", "cls", "copies", "data"],
        )

    sorted_ = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("cls", "copies", "label", "embedding", "dim")
    out = f"block long, label {label}, dim int, low array<double>, high array<double>, cls array<string>, copies array<long>, data {kind}"
    return stored(sorted_.mapInArrow(cut, out), "blocks")


def _near_blocks(ranges: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a <= b: the blocks of a label and length whose ranges are near enough to hold a pair, stored.

    Partners lie within the radius in each coordinate, so a block's own cells of the two
    first coordinates, widened by one radius, hold a cell of each of its partners.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def cells(wide: float) -> list[Column]:
        spans = []
        for k in (0, 1):
            low, high = (F.coalesce(F.get(name, F.lit(k)), F.lit(0.0)) for name in ("low", "high"))
            spans.append(F.sequence(F.floor((low - wide) / radius), F.floor((high + wide) / radius)))
        return spans

    def listed(wide: float, side: str) -> DataFrame:
        first, second = cells(wide)
        rows = ranges.withColumn("c0", F.explode(first)).withColumn("c1", F.explode(second))
        return rows.select("label", "dim", "c0", "c1", F.col("block").alias(side), F.struct("low", "high").alias(f"r{side}"))

    gaps = F.zip_with(
        F.arrays_zip(F.col("ra.low").alias("low"), F.col("ra.high").alias("high")),
        F.arrays_zip(F.col("rb.low").alias("low"), F.col("rb.high").alias("high")),
        lambda x, y: F.greatest(F.lit(0.0), x["low"] - y["high"], y["low"] - x["high"]),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    met = listed(radius, "a").join(listed(0.0, "b"), ["label", "dim", "c0", "c1"])
    near = met.where((F.col("a") <= F.col("b")) & (apart <= radius * radius + SLACK))
    return stored(near.select("a", "b").distinct(), "near-blocks")


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    names = [F.hex(F.xxhash64(*seed, "label", "embedding")) for seed in ((), (F.lit(1),))]
    cls = F.when(_valid(), F.concat(*[F.lpad(name, 16, "0") for name in names]))
    named = rows.select("vec_id", cls.alias("cls"), "label", "embedding").where("cls is not null")
    classes = named.groupBy("cls").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    classes = stored(classes, "vectors")
    bases = spark.sparkContext.broadcast(_bases(classes.select("embedding")))
    blocks = _blocks(classes, bases)
    pairs = _near_blocks(blocks.select("block", "label", "dim", "low", "high"), threshold)
    left, right = (
        blocks.select(F.col("block").alias(side), *(F.col(name).alias(f"{name}_{side}") for name in ("dim", "cls", "copies", "data")))
        for side in ("a", "b")
    )
    tiles = pairs.join(left, "a").join(right.drop("dim_b"), "b")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = {name: batch.column(name)[k] for name in batch.schema.names}
                dim, alone = one["dim_a"].as_py(), one["a"].as_py() == one["b"].as_py()
                sides = ("a",) if alone else ("a", "b")
                parts = [one[f"data_{side}"].values.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64) for side in sides]
                ids = pa.concat_arrays([one[f"cls_{side}"].values for side in sides])
                copies = np.concatenate([one[f"copies_{side}"].values.to_numpy() for side in sides])
                i, j = compare_tile(parts[0], parts[-1], bases.value[dim], threshold, alone)
                j = j if alone else j + len(parts[0])
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                root = forest(len(ids), i, j)
                some = np.flatnonzero(links > 0)
                columns = [ids.take(pa.array(some)), ids.take(pa.array(root[some])), pa.array(links[some].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n"])

    linked = tiles.mapInArrow(tile, "a string, b string, n long")
    linked = stored(linked, "links")
    counts = linked.groupBy("a").agg(F.sum("n").alias("n"))
    # a repeated vec_id connects the classes of its rows
    signs = rows.select("vec_id", cls.alias("cls"))
    ends = signs.where("cls is not null").groupBy("vec_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z")
    again = signs.join(ends.select("vec_id", "a"), "vec_id").select("a", F.col("cls").alias("b"))
    found = components(linked.select("a", "b").unionByName(again), "a", "b")
    part = classes.select("cls", "rep", "copies").join(found, F.col("cls") == F.col("node"), "left")
    part = stored(part.withColumn("part", F.coalesce("component", "cls")), "parts")
    least = stored(part.groupBy("part").agg(F.min("rep").alias("least")), "least")
    info = part.join(least, "part").join(counts, F.col("cls") == F.col("a"), "left")
    # stored, so that Spark can split the rows of a hot class
    info = stored(info.select("cls", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")), "info")
    joined = signs.join(info, "cls", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
