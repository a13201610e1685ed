"""M1, M2: a table of one row per key whose upserts rewrite only the buckets that change.

Rows lie in buckets by a hash of the key, ``data/version=N/bucket=B/``. A version is a
manifest, committed last, that tells for each bucket which version's files hold it. So
an upsert writes the buckets with changed rows and one small manifest, and older
versions stay readable until they are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.functions.sketches import key_bucket
from eventpulse.sinks.files import numbered, remove
from eventpulse.sinks.tables import VersionedTable

BUCKETS = 64
POINTERS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("data", T.IntegerType())])


class BucketedTable:
    """Versions of a keyed table. ``buckets`` belongs to the table: later sessions must give the same number."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets
        self.manifest = VersionedTable(spark, path, POINTERS)

    def versions(self) -> list[int]:
        return self.manifest.versions()

    def pointers(self, version: int | None = None) -> dict[int, int]:
        """Which version's files hold each bucket; buckets without rows are absent."""
        return {row.bucket: row.data for row in self.manifest.read(version).collect()}

    def _bucket(self):
        return key_bucket(F.col(self.key).cast("string"), self.buckets)

    def _read(self, pointers: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/version={data}/bucket={bucket}" for bucket, data in sorted(pointers.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.pointers(version))

    def _next(self) -> int:
        taken = (*numbered(self.spark, self.path, "version"), *numbered(self.spark, f"{self.path}/data", "version"))
        return max(taken, default=-1) + 1

    def _write(self, rows: DataFrame, version: int, buckets: int) -> None:
        """Each bucket is one file, however many buckets a task writes."""
        placed = rows.select(self.schema.fieldNames()).withColumn("bucket", self._bucket())
        gathered = placed.repartition(max(1, buckets), "bucket").sortWithinPartitions("bucket", self.key)
        gathered.write.mode("errorifexists").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")

    def _point(self, pointers: dict[int, int], version: int) -> int:
        rows = self.spark.createDataFrame(sorted(pointers.items()), POINTERS).coalesce(1)
        rows.write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return version

    def publish(self, df: DataFrame) -> int:
        """Replace the whole table."""
        version = self._next()
        self._write(df, version, self.buckets)
        return self._point(dict.fromkeys(numbered(self.spark, f"{self.path}/data/version={version}", "bucket"), version), version)

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame, str], DataFrame], base: int | None = None) -> int:
        """A version with ``new`` (one row per key) merged into ``base``, by default the newest version.

        ``merge(old, new, key)`` gets the old rows of the incoming keys only. The rows it
        changes name the buckets to rewrite; if there is none, no version is written and
        that of ``base`` is returned.
        """
        base = max(self.versions(), default=None) if base is None else base
        pointers = {} if base is None else self.pointers(base)
        new = new.where(F.col(self.key).isNotNull()).select(self.schema.fieldNames()).persist()
        try:
            met = [row[0] for row in new.select(self._bucket()).distinct().collect()]
            old = self._read({b: pointers[b] for b in met if b in pointers})
            same = old.join(new.select(self.key), self.key, "left_semi")
            changed = merge(same, new, self.key).exceptAll(same.select(self.schema.fieldNames())).persist()
            try:
                touched = sorted(row[0] for row in changed.select(self._bucket()).distinct().collect())
                if not touched and base is not None:
                    return base
                version = self._next()
                kept = self._read({b: pointers[b] for b in touched if b in pointers})
                rows = kept.join(changed.select(self.key), self.key, "left_anti").select(self.schema.fieldNames())
                self._write(rows.unionByName(changed), version, len(touched))
                return self._point(pointers | dict.fromkeys(touched, version), version)
            finally:
                changed.unpersist()
        finally:
            new.unpersist()

    def drop(self, version: int) -> None:
        """Delete a version and the files that no other version points to."""
        own = set(self.pointers(version).items()) if version in self.versions() else set()
        self.manifest.drop(version)
        others = [set(self.pointers(n).items()) for n in self.versions()]
        for bucket, data in own - set().union(*others):
            remove(self.spark, f"{self.path}/data/version={data}/bucket={bucket}")
