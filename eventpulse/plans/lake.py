"""The tables of one deployment under one root path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventpulse import schemas
from eventpulse.operators.rollups import add_up, rollup_totals
from eventpulse.sinks.buckets import BUCKETS, BucketedTable
from eventpulse.sinks.files import first_text
from eventpulse.sinks.keyindex import KeyIndex
from eventpulse.sinks.tables import BatchTable, TableSet, VersionedTable

ENRICHED = [T.StructField("repo_owner", T.StringType()), T.StructField("repo_short_name", T.StringType())]

# Membership filters let point lookups skip row groups that sorting cannot. They are
# too large for the small files of a micro-batch.
LOOKUPS = {
    f"parquet.bloom.filter.{setting}": "true"
    for setting in ("adaptive.enabled", "enabled#event_id", "enabled#actor_login")
}


ROLLUPS = {
    "minute": schemas.MINUTE,
    "types": schemas.TYPES,
    "repo_activity": schemas.REPO_ACTIVITY,
    "actor_activity": schemas.ACTOR_ACTIVITY,
}


def _fields(schema: T.StructType, *extra: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *extra])


class Lake:
    """Quarantine, fact and its ids (silver), rollups by batch and by version, dimensions (gold)."""

    def __init__(self, spark: SparkSession, root: str, enrich: bool = False, dim_buckets: int = BUCKETS):
        self.spark, self.root, self.enrich = spark, root, enrich
        date = T.StructField("event_date", T.DateType())
        self.fact = BatchTable(
            spark,
            f"{root}/fact",
            _fields(schemas.FACT, *(ENRICHED if enrich else []), date),
            partition_by=["event_date"],
            sort_by=["repo_id", "event_created_at"],
            compact_options=LOOKUPS,
        )
        self.keys = KeyIndex(spark, f"{root}/keys")
        self.quarantine = BatchTable(spark, f"{root}/quarantine", schemas.QUARANTINE)
        self.metrics = BatchTable(spark, f"{root}/metrics", schemas.INGEST_METRICS)
        self.partials = BatchTable(
            spark, f"{root}/partials", schemas.PARTIALS, partition_by=["rollup"], merge=add_up
        )
        self.rollups = {
            name: VersionedTable(spark, f"{root}/rollups/{name}", schema)
            for name, schema in ROLLUPS.items()
        }
        self.repos = BucketedTable(spark, f"{root}/dims/repos", schemas.REPOS, "repo_id", dim_buckets)
        self.actors = BucketedTable(spark, f"{root}/dims/actors", schemas.ACTORS, "actor_id", dim_buckets)
        self.rollup_set = TableSet(spark, f"{root}/rollups", self.rollups)
        self.dim_set = TableSet(spark, f"{root}/dims", {"repos": self.repos, "actors": self.actors})

    def totals(self, name: str, upto: int | None = None) -> DataFrame:
        """The incremental form of a rollup, all batches added up."""
        return rollup_totals(self.partials.read(upto), name)

    def bind(self, checkpoint: str) -> None:
        """K5, K6: refuse a checkpoint whose batch ids are not those of this lake.

        The stream's id in the checkpoint is kept with the lake. A new checkpoint has
        none and would begin at batch 0 again, over batches that are there.
        """
        stream = first_text(self.spark, f"{checkpoint}/metadata")
        owner = first_text(self.spark, f"{self.root}/stream")
        if owner is not None and owner != stream:
            raise ValueError(f"{self.root} belongs to another checkpoint than {checkpoint}")
        if stream is None and (self.fact.batches() or self.fact.compactions()):
            raise ValueError(f"{self.root} holds batches that {checkpoint} does not know")

    def own(self, checkpoint: str) -> None:
        """Keep the id of the stream that has just started on the checkpoint."""
        if first_text(self.spark, f"{self.root}/stream") is None:
            stream = first_text(self.spark, f"{checkpoint}/metadata")
            row = self.spark.createDataFrame([(stream,)], "value string").coalesce(1)
            row.write.mode("overwrite").text(f"{self.root}/stream")

    def _batch_tables(self) -> tuple[BatchTable | KeyIndex, ...]:
        return self.fact, self.keys, self.quarantine, self.partials, self.metrics

    def compact(self) -> None:
        """Merge small batches, so that a read lists few directories."""
        for table in self._batch_tables():
            table.compact()

    def expire(self) -> None:
        """Delete what compactions and later versions have replaced."""
        for table in (*self._batch_tables(), self.rollup_set, self.dim_set):
            table.expire()
