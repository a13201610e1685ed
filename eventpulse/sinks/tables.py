"""Parquet tables written by batch or by version.

Both kinds rest on a directory that one job overwrites as a whole and that
counts only when the job's success marker is there. A repeated write therefore
converges, and a reader never sees half a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.sinks.files import committed, numbered, remove

if TYPE_CHECKING:
    from eventpulse.sinks.buckets import BucketedTable


def _arranged(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value and sorted within, for few files with tight statistics.

    The rebalance hint lets AQE split a large partition value over several tasks
    and join small ones, so one hot date is not one task.
    """
    if not sort_by:
        return df
    gathered = df.hint("rebalance", *[F.col(name) for name in partition_by])
    return gathered.sortWithinPartitions(*partition_by, *sort_by)


def _read_paths(spark: SparkSession, base: str, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.fieldNames())


class BatchTable:
    """Rows addressed by the batch that wrote them: ``batches/batch_id=N/[partition/]``.

    With ``sort_by``, rows are gathered by partition and sorted before they are written.
    ``merge`` tells how the rows of several batches combine when compacted:
    kept as they are by default, or for instance summed by key. ``compact_options``
    are writer options that only pay off in the large files of a compaction.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        merge: Callable[[DataFrame], DataFrame] | None = None,
        compact_options: dict[str, str] | None = None,
    ):
        self.spark, self.schema, self.merge = spark, schema, merge
        self.partition_by, self.sort_by = partition_by, sort_by
        self.compact_options = compact_options or {}
        self._batches, self._compacted = f"{path}/batches", f"{path}/compacted"

    def _write(self, df: DataFrame, path: str, **options: str) -> None:
        arranged = _arranged(df.select(self.schema.fieldNames()), self.partition_by, self.sort_by)
        writer = arranged.write.mode("overwrite").options(**options)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(path)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """K6: replace what the batch wrote before, if anything.

        A batch that a compaction holds already would be written and never read.
        """
        done = self.compactions()
        if done and batch_id <= done[-1]:
            raise ValueError(f"batch {batch_id} is part of the compaction up to {done[-1]}")
        self._write(df, f"{self._batches}/batch_id={batch_id}")

    def batches(self) -> list[int]:
        """Committed batches. They are written in order, so only the last may be unfinished."""
        ids = numbered(self.spark, self._batches, "batch_id")
        while ids and not committed(self.spark, f"{self._batches}/batch_id={ids[-1]}"):
            ids.pop()
        return ids

    def compactions(self) -> list[int]:
        """Finished compactions; a failed one may lie anywhere and stays unread."""
        ids = numbered(self.spark, self._compacted, "upto")
        return [n for n in ids if committed(self.spark, f"{self._compacted}/upto={n}")]

    def last_batch(self) -> int | None:
        ids = self.batches()
        return ids[-1] if ids else None

    def read_batch(self, batch_id: int) -> DataFrame:
        base = self._batches
        return _read_paths(self.spark, base, [f"{base}/batch_id={batch_id}"], self.schema)

    def read_compaction(self, upto: int) -> DataFrame:
        """Rows of one compaction: of the batches since the one before."""
        base = self._compacted
        return _read_paths(self.spark, base, [f"{base}/upto={upto}"], self.schema)

    def read_after(self, batch_id: int, upto: int | None = None) -> DataFrame:
        """Rows of the committed batches after one, all or up to another."""
        base = self._batches
        fresh = [n for n in self.batches() if n > batch_id and (upto is None or n <= upto)]
        if not fresh:
            return self.spark.createDataFrame([], self.schema)
        return _read_paths(self.spark, base, [f"{base}/batch_id={n}" for n in fresh], self.schema)

    def read(self, upto: int | None = None) -> DataFrame:
        """Rows of all committed batches, or of those up to ``upto``: a fixed snapshot.

        Each compaction holds the batches since the one before, so the batches
        after the last one complete it.
        """
        done = self.compactions()
        folds = [n for n in done if upto is None or n <= upto]
        after = folds[-1] if folds else -1
        live = [n for n in self.batches() if n > after and (upto is None or n <= upto)]
        if len(folds) < len(done) and live != list(range(after + 1, upto + 1)):
            raise ValueError(f"batches up to {upto} are no longer kept apart from later ones")
        parts = [
            _read_paths(self.spark, base, [f"{base}/{name}={n}" for n in ids], self.schema)
            for base, name, ids in ((self._compacted, "upto", folds), (self._batches, "batch_id", live))
            if ids
        ]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self) -> int | None:
        """Merge the batches since the last compaction into one directory.

        The newest batch is left out, because its writer may still repeat it.
        Returns the last batch that is now compacted.
        """
        done = self.compactions()
        after = done[-1] if done else -1
        fresh = [n for n in self.batches()[:-1] if n > after]
        if not fresh:
            return done[-1] if done else None
        base = self._batches
        rows = _read_paths(self.spark, base, [f"{base}/batch_id={n}" for n in fresh], self.schema)
        merged = self.merge(rows) if self.merge else rows
        self._write(merged, f"{self._compacted}/upto={fresh[-1]}", **self.compact_options)
        return fresh[-1]

    def forget(self, upto: int) -> None:
        """Delete the batches up to one, when another table holds what is still needed of them."""
        for n in numbered(self.spark, self._batches, "batch_id"):
            if n <= upto:
                remove(self.spark, f"{self._batches}/batch_id={n}")

    def expire(self) -> None:
        """Delete batches that a compaction replaced, except the newest compaction's:
        readers that began before it may still hold them."""
        done = self.compactions()
        for n in numbered(self.spark, self._batches, "batch_id") if len(done) > 1 else []:
            if n <= done[-2]:
                remove(self.spark, f"{self._batches}/batch_id={n}")


class VersionedTable:
    """K2: a table refreshed as a whole; readers see the newest finished version.

    Tables that must agree belong into a TableSet.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def publish(self, df: DataFrame) -> int:
        version = max(numbered(self.spark, self.path, "version"), default=-1) + 1
        df.select(self.schema.fieldNames()).write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return version

    def versions(self) -> list[int]:
        """Finished versions."""
        found = numbered(self.spark, self.path, "version")
        return [n for n in found if committed(self.spark, f"{self.path}/version={n}")]

    def read(self, version: int | None = None) -> DataFrame:
        """The newest finished version, or the one named."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={version}")

    def drop(self, version: int) -> None:
        remove(self.spark, f"{self.path}/version={version}")

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest finished versions."""
        for version in self.versions()[:-max(keep, 1)]:
            self.drop(version)


class TableSet:
    """K2: several versioned tables that are refreshed together.

    The versions of one refresh are written first, then a manifest that names them
    all. Readers take the versions of the newest finished manifest, so they see one
    refresh or the one before, whenever a writer dies and however long it takes.
    """

    MANIFEST = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("version", T.IntegerType())])

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, VersionedTable | BucketedTable]):
        self.spark, self.tables = spark, tables
        self.manifest = VersionedTable(spark, f"{path}/manifest", self.MANIFEST)

    def publish(self, frames: dict[str, DataFrame]) -> dict[str, int]:
        self._complete(frames)
        return self.commit({name: self.tables[name].publish(df) for name, df in frames.items()})

    def _complete(self, named: Iterable[str]) -> None:
        if set(named) != self.tables.keys():
            raise ValueError(f"a refresh needs all of {sorted(self.tables)}")

    def commit(self, versions: dict[str, int]) -> dict[str, int]:
        """Let readers see these versions, which are finished already."""
        self._complete(versions)
        self.manifest.publish(self.spark.createDataFrame(list(versions.items()), self.MANIFEST).coalesce(1))
        return versions

    def versions(self, manifest: int | None = None) -> dict[str, int]:
        """What a manifest names, by default the newest one; empty before the first refresh."""
        return {row.table_name: row.version for row in self.manifest.read(manifest).collect()}

    def read(self) -> dict[str, DataFrame]:
        """All tables as of one refresh."""
        versions = self.versions()
        empty = self.spark.createDataFrame
        return {name: table.read(versions[name]) if versions else empty([], table.schema) for name, table in self.tables.items()}

    def expire(self, keep: int = 2) -> None:
        """Delete manifests but the newest, and versions that none of these names.

        Versions newer than those of the newest manifest stay: a refresh may be writing them.
        """
        kept = self.manifest.versions()[-max(keep, 1):]
        if not kept:
            return
        named = [self.versions(n) for n in kept]
        for n in self.manifest.versions()[: -len(kept)]:
            self.manifest.drop(n)
        for name, table in self.tables.items():
            used = {versions[name] for versions in named}
            for version in numbered(self.spark, table.path, "version"):
                if version < max(used) and version not in used:
                    table.drop(version)
