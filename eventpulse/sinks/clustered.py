"""M4, M5: a table laid out for lookups by any of several columns.

Each column is cut into up to SLICES ranges that hold as many distinct values each. The
bits of a row's slice numbers, interleaved from the highest on, are its place on a
Z-order curve; rows are written in the order of that place, a file being one stretch
of it. So a file covers a narrow range of every column, not only of a first one. The
ranges of all files are kept beside them, committed last, and a lookup opens the files
whose ranges admit its values.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.sinks.files import numbered, remove
from eventpulse.sinks.tables import VersionedTable
from eventpulse.sources.scans import scan_range

BITS = 4
SLICES = 1 << BITS
FILE_ROWS = 1_000_000
#: Files of fewer rows than FILE_ROWS, as ``file_rows`` may ask for, are made up to this number only.
SMALL_FILES = 512


def slice_bounds(df: DataFrame, column: str, slices: int = SLICES) -> list[object]:
    """The largest value of each slice but the last one: at most ``slices - 1`` values, in order.

    Distinct values are sorted into ranges by Spark's range partitioning, for any type.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    cut = values.repartitionByRange(slices, column).groupBy(F.spark_partition_id()).agg(F.max(column).alias("top"))
    return sorted(row.top for row in cut.collect())[:-1]


def curve_place(columns: dict[str, list[object]]) -> Column:
    """Interleaved bits of the slice numbers; NULL is in the first slice.

    The numbers of a column with few slices are spread over all bits, so that it takes
    part in the high ones.
    """
    numbers = []
    for column, bounds in columns.items():
        number = F.lit(0)
        for k, bound in enumerate(bounds, 1):
            number = F.when(F.col(column) > F.lit(bound), k * SLICES // (len(bounds) + 1)).otherwise(number)
        numbers.append(number)

    def interleaved(found: Column) -> Column:
        place = F.lit(0).cast("bigint")
        for bit in reversed(range(BITS)):
            for k in range(len(numbers)):
                place = place * 2 + F.shiftright(found[k], bit).bitwiseAND(1)
        return place

    # through an array, so that each number is found once a row and not once a bit
    return F.transform(F.array(F.array(*numbers)), interleaved)[0]


def file_count(rows: int, file_rows: int) -> int:
    """Files of ``file_rows`` rows, in a large table of more, so that their number grows with FILE_ROWS alone."""
    return max(1, min(-(-rows // file_rows), SMALL_FILES), -(-rows // max(file_rows, FILE_ROWS)))


class ClusteredTable:
    """Versions of a table with the ranges of their files; ``lookups`` are the columns asked for."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, lookups: Sequence[str], file_rows: int = FILE_ROWS):
        self.spark, self.path, self.schema, self.lookups, self.file_rows = spark, path, schema, list(lookups), file_rows
        limits = [T.StructField(f"{side}_{name}", schema[name].dataType) for name in self.lookups for side in ("least", "most")]
        self.ranges = VersionedTable(spark, f"{path}/ranges", T.StructType([T.StructField("file", T.StringType()), *limits]))

    def publish(self, df: DataFrame) -> int:
        """A new version; it counts once the ranges of its files are written."""
        version = max(numbered(self.spark, f"{self.path}/data", "version"), default=-1) + 1
        folder = f"{self.path}/data/version={version}"
        rows = df.select(self.schema.fieldNames())
        files = file_count(rows.count(), self.file_rows)
        place = curve_place({name: slice_bounds(rows, name) for name in self.lookups})
        placed = rows.withColumn("place", place)
        # equal places are split by the columns themselves, so a crowded place is no single file
        laid = placed.repartitionByRange(files, "place", *self.lookups).sortWithinPartitions("place", *self.lookups)
        laid.drop("place").write.mode("errorifexists").parquet(folder)
        written = self.spark.read.schema(self.schema).parquet(folder)
        limits = [f(name).alias(f"{side}_{name}") for name in self.lookups for side, f in (("least", F.min), ("most", F.max))]
        ranges = written.groupBy(F.concat(F.lit(f"{version}/"), F.col("_metadata.file_name")).alias("file")).agg(*limits)
        self.ranges.publish(ranges.coalesce(1))
        return version

    def files(self, start: datetime | None = None, end: datetime | None = None, time: str = "event_created_at", **equals: object) -> list[str]:
        """The files whose ranges admit the values; at most all of the version's."""
        found = self.ranges.read()
        if start is not None:
            found = found.where(F.col(f"most_{time}") >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            found = found.where(F.col(f"least_{time}") < F.lit(end).cast("timestamp_ntz"))
        for name, value in equals.items():
            if name in self.lookups:
                found = found.where(F.lit(value).between(F.col(f"least_{name}"), F.col(f"most_{name}")))
        return sorted(row.file for row in found.select("file").collect())

    def read(self) -> DataFrame:
        return self._open(self.files())

    def _open(self, files: list[str]) -> DataFrame:
        paths = [f"{self.path}/data/version={name}" for name in files]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def lookup(self, start: datetime | None = None, end: datetime | None = None, time: str = "event_created_at", **equals: object) -> DataFrame:
        """M4, M5: rows with ``start <= time < end`` and the given values, from those files alone."""
        return scan_range(self._open(self.files(start, end, time, **equals)), start, end, time, **equals)

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest versions, and what writers that died have left before them."""
        kept = self.ranges.versions()[-max(keep, 1):]
        used = {int(row.version) for n in kept for row in self.ranges.read(n).select(F.split_part("file", F.lit("/"), F.lit(1)).alias("version")).distinct().collect()}
        for version in numbered(self.spark, f"{self.path}/data", "version"):
            if version < max(used, default=-1) and version not in used:
                remove(self.spark, f"{self.path}/data/version={version}")
        self.ranges.expire(keep)
