"""Landed JSON arrays of any size, one array read by several tasks.

A file is read as fragments between commas, so Spark cuts it at any byte range. Whether
a comma parts two elements depends on all text before it: on whether a string is open
there, and on how many brackets are. A range flips the first or not, and changes the
second by one number if it begins outside a string and by another if it begins inside.
Such changes add up over the ranges of a file, of which there are few. So the text is
read twice: once for the changes of each range, and once, with the state at the start of
each range known, to cut it at the commas at depth 1 outside strings. An element inside
a range is whole by then and is not shuffled. Only the first and the last piece of a
range are, and those of an element are joined again by its number.

A task reads the fragments of a range in their order, so it carries the state from one
Arrow batch to the next; states are sums over the bytes of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventpulse.session import work_dir

RANGE = ["file", "block"]


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, text): fragments in the order they have in a byte range of a file, which is named by a hash."""
    lines = spark.read.option("lineSep", ",").text(path)
    name = F.xxhash64(F.col("_metadata.file_path"))
    return lines.select(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))


def _joined(texts: pa.Array) -> np.ndarray:
    """The bytes of the texts, each with a comma after it."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.insert(data, offsets[1:] - offsets[0], ord(","))


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte is a quote, and what it adds to the depth if it is outside strings; escaped ones are and add nothing."""
    quote = data == ord('"')
    lower = data | 0x20
    step = (lower == ord("{")).astype(np.int8) - (lower == ord("}")).astype(np.int8)
    slash = data == ord("\\")
    if slash.any():
        # escaped: an odd number of backslashes stands before; none goes on past a comma
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slash, -1, at))
        escaped = np.zeros(len(data), bool)
        escaped[1:] = (at[:-1] - last[:-1]) % 2 == 1
        quote &= ~escaped
        step[escaped] = 0
    return quote, step


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The parts of a batch by range."""
    file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if lo < hi:
            yield (int(file[lo]), int(block[lo])), batch.slice(lo, hi - lo)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: whether it flips, its change of depth if begun outside or inside a string, its first and last fragment."""
    key, found = None, []

    def row() -> pa.RecordBatch:
        names = ["file", "block", "flips", "range0", "range1", "first", "last"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*key, *found], types, strict=True)], names)

    for batch in batches:
        for now, part in _runs(batch):
            texts = part.column(2).cast(pa.binary())
            if now != key:
                if key is not None:
                    yield row()
                key, found = now, [0, 0, 0, texts[0].as_py(), None]
            quote, step = _marks(_joined(texts))
            inside = (np.cumsum(quote) + found[0]) % 2
            found[1] += int(step[inside == 0].sum())
            found[2] += int(step[inside == 1].sum())
            found[0] = (found[0] + int(quote.sum())) % 2
            found[4] = texts[-1].as_py()
    if key is not None:
        yield row()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, number, edge, json): each range cut into elements, numbered from 0; the first and the last piece are edges."""
    key, inside, depth, number, kept = None, 0, 0, 0, []

    def rows(numbers: list[int], edge: list[bool], texts: pa.Array) -> pa.RecordBatch:
        n = len(numbers)
        columns = [pa.array([k] * n, pa.int64()) for k in key]
        columns += [pa.array(numbers, pa.int64()), pa.array(edge, pa.bool_()), texts]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "number", "edge", "json"])

    def rest() -> pa.RecordBatch:
        # without the comma after the last fragment; null if that comma parts two elements
        text = b"".join(kept)
        return rows([number], [True], pa.array([text[:-1] if text else None], pa.binary()))

    for batch in batches:
        for now, part in _runs(batch):
            if now != key:
                if key is not None:
                    yield rest()
                key, number, kept = now, 0, []
                inside, depth = part.column(3)[0].as_py(), part.column(4)[0].as_py()
            data = _joined(part.column(2).cast(pa.binary()))
            quote, step = _marks(data)
            within = (np.cumsum(quote) + inside) % 2
            level = np.cumsum(np.where(within == 0, step, 0), dtype=np.int64) + depth
            cuts = np.flatnonzero((data == ord(",")) & (within == 0) & (level == 1))
            inside, depth = int(within[-1]), int(level[-1])
            if not len(cuts):
                kept.append(data.tobytes())
                continue
            # the carried text ends at the first cut; elements between cuts lie side by side once their commas are left out
            kept.append(data[: cuts[0]].tobytes())
            yield rows([number], [number == 0], pa.array([b"".join(kept)], pa.binary()))
            body = np.delete(data[cuts[0] : cuts[-1]], cuts[:-1] - cuts[0])
            ends = np.concatenate(([0], np.cumsum(np.diff(cuts) - 1))).astype(np.int32)
            whole = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(body)])
            if len(whole):
                yield rows(list(range(number + 1, number + len(cuts))), [False] * len(whole), whole)
            number += len(cuts)
            kept = [data[cuts[-1] + 1 :].tobytes()]
    if key is not None:
        yield rest()


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A few rows for each byte range, written so that the text is not read again for them."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sum(column: Column | str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def split_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(response, json): one row for each element of the JSON arrays in the files of a path.

    Elements keep their own text. An empty array has no rows. A file that is no array, or
    in which brackets or strings stay open, becomes one row with its first fragment, so
    that the classification rejects it.
    """
    fragments = _fragments(spark, path)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    changes = "file long, block long, flips int, range0 long, range1 long, first binary, last binary"
    ranges = _kept(fragments.mapInArrow(_changes, changes), "array-ranges")
    starts = ranges.withColumn("start_inside", (_sum("flips", before) % 2).cast("int"))
    starts = starts.withColumn("step", F.when(F.col("start_inside") == 0, F.col("range0")).otherwise(F.col("range1")))
    starts = starts.withColumn("start_depth", _sum("step", before))
    # a file begins outside of all, so only ranges within one are sent to the tasks
    later = F.broadcast(starts.where("block > 0").select(*RANGE, "start_inside", "start_depth"))
    state = [F.coalesce(name, F.lit(0)).alias(name) for name in ("start_inside", "start_depth")]
    known = fragments.join(later, RANGE, "left").select(*RANGE, "text", *state)
    pieces = known.mapInArrow(_pieces, "file long, block long, number long, edge boolean, json binary")

    edges = _kept(pieces.where("edge"), "array-edges")
    counted = edges.groupBy(*RANGE).agg(F.max("number").alias("parts"))
    counted = counted.select(*RANGE, "parts", _sum("parts", before).alias("start_number"))
    placed = edges.join(counted, RANGE).withColumn("element", F.col("start_number") + F.col("number"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "json"))), lambda p: p["json"].cast("string"))
    seams = placed.groupBy("file", "element").agg(F.array_join(parts, ",").alias("json"))

    ends = starts.groupBy("file").agg(
        F.sum("step").alias("depth"), (F.sum("flips") % 2).alias("inside"),
        F.min_by(F.col("first").cast("string"), "block").alias("first"), F.max_by(F.col("last").cast("string"), "block").alias("last"),
    )
    ends = ends.join(counted.groupBy("file").agg(F.sum("parts").alias("last_element")), "file")
    begins, closes = F.ltrim(_blanks("first")).startswith("["), F.rtrim(_blanks("last")).endswith("]")
    sound = begins & closes & (F.col("depth") == 0) & (F.col("inside") == 0)
    ends = ends.select("file", "last_element", sound.alias("sound"), F.col("first").alias("first_text"))
    paths = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("response"))
    ends = ends.join(paths.withColumn("file", F.xxhash64("response")), "file")
    inner = pieces.where("not edge").select("file", F.lit(None).cast("long").alias("element"), F.col("json").cast("string").alias("json"))
    return _unwrapped(inner.unionByName(seams).join(ends, "file"))


def _blanks(text: str) -> Column:
    """JSON's white space as spaces."""
    return F.translate(text, "\t\n\r", "   ")


def _unwrapped(texts: DataFrame) -> DataFrame:
    """Without the array's own brackets and the blanks about elements; broken files as one row."""
    json = F.coalesce("json", F.lit(""))
    json = F.when(F.col("element") == 0, F.regexp_replace(json, r"\A\s*\[", "")).otherwise(json)
    json = F.when(F.col("element") == F.col("last_element"), F.regexp_replace(json, r"\]\s*\z", "")).otherwise(json)
    json = F.regexp_replace(json, r"\A\s+|\s+\z", "")
    whole = F.when(F.col("sound"), json).when(F.col("element") == 0, F.col("first_text"))
    rows = texts.select("response", "sound", "last_element", whole.alias("json")).where(F.col("json").isNotNull())
    empty = F.col("sound") & (F.col("last_element") == 0) & (F.col("json") == "")
    return rows.where(~empty).select("response", "json")
