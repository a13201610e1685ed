"""The key check of a growing table, kept up batch by batch.

Keys are counted by bucket of their hash. A batch adds, for each bucket, its rows, the
sum of its keys' hashes, and how many of its keys no batch before has stored. All of
that adds up over batches, whatever their order of rows. Where a bucket has more rows
than keys that were new, some key occurs twice, and that bucket alone is counted
again, from a copy of the keys by bucket. The sums also tell whether a table still
holds what its batches wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.functions.sketches import key_bucket
from eventpulse.sinks.keyindex import KeyIndex
from eventpulse.sinks.tables import BatchTable

BUCKETS = 256
SUMS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_new", T.LongType()),
        T.StructField("print", T.DecimalType(38, 0)),
    ]
)
KEYS = T.StructType([T.StructField("key", T.StringType()), T.StructField("bucket", T.IntegerType())])
#: The bucket of rows whose key is NULL.
NULLS = -1


def _add(rows: DataFrame) -> DataFrame:
    sums = [F.sum(name).cast(SUMS[name].dataType).alias(name) for name in ("n_rows", "n_new", "print")]
    return rows.groupBy("bucket").agg(*sums).select(SUMS.fieldNames())


class KeyAudit:
    """The declared key of one table; ``buckets`` belongs to the audit's folder."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.index = KeyIndex(spark, f"{path}/index", key="key")
        self.sums = BatchTable(spark, f"{path}/sums", SUMS, merge=_add)
        self.keys = BatchTable(spark, f"{path}/keys", KEYS, partition_by=["bucket"], sort_by=["key"])

    def _keys(self, rows: DataFrame) -> DataFrame:
        key = F.col(self.key).cast("string")
        return rows.select(key.alias("key"), F.coalesce(self._bucket(key), F.lit(NULLS)).alias("bucket"))

    def _bucket(self, key: Column) -> Column:
        return F.when(key.isNotNull(), key_bucket(key, self.buckets))

    @staticmethod
    def _print() -> Column:
        return F.sum(F.coalesce(F.xxhash64("key", F.lit(3)), F.lit(0)).cast("decimal(38,0)")).cast("decimal(38,0)")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add what one batch has written; repeating a batch replaces its part."""
        self.keys.write(self._keys(rows), batch_id)
        stored = self.keys.read_batch(batch_id)
        per_key = stored.groupBy("key", "bucket").agg(F.count("*").alias("n"))
        known = self.index.near(stored, upto=batch_id - 1).distinct().withColumn("old", F.lit(True))
        marked = per_key.join(known, "key", "left").persist()
        try:
            hashed = F.coalesce(F.xxhash64("key", F.lit(3)), F.lit(0)).cast("decimal(38,0)")
            sums = marked.groupBy("bucket").agg(
                F.sum("n").alias("n_rows"),
                F.count_if(F.col("old").isNull() & F.col("key").isNotNull()).alias("n_new"),
                F.sum(hashed * F.col("n")).cast("decimal(38,0)").alias("print"),
            )
            self.sums.write(sums, batch_id)
            self.index.write(marked.where("old is null").select("key"), batch_id)
        finally:
            marked.unpersist()

    def totals(self, upto: int | None = None) -> DataFrame:
        """(bucket, n_rows, n_new, print) of all batches, or up to one."""
        return _add(self.sums.read(upto))

    def suspects(self, upto: int | None = None) -> list[int]:
        """Buckets in which some key occurs more than once."""
        found = self.totals(upto).where(f"bucket <> {NULLS} and n_rows > n_new")
        return sorted(row.bucket for row in found.select("bucket").collect())

    def repeated(self, upto: int | None = None) -> DataFrame:
        """(key, row_count) of keys that occur more than once, from the buckets that have some."""
        rows = self.keys.read(upto).where(F.col("bucket").isin(self.suspects(upto)))
        return rows.groupBy("key").agg(F.count("*").alias("row_count")).where("row_count > 1")

    def summary(self, name: str, upto: int | None = None) -> DataFrame:
        """One row (table_name, repeated_keys, null_keys), as key_summary() has it."""
        nulls = self.totals(upto).where(f"bucket = {NULLS}").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("null_keys"))
        found = self.repeated(upto).agg(F.count("*").alias("repeated_keys"))
        # two tables of one row each
        return found.join(nulls).select(F.lit(name).alias("table_name"), "repeated_keys", "null_keys")

    def drifted(self, table: DataFrame, upto: int | None = None) -> DataFrame:
        """Buckets in which ``table`` does not hold the keys that its batches wrote."""
        now = self._keys(table).groupBy("bucket").agg(F.count("*").alias("rows_now"), self._print().alias("print_now"))
        both = self.totals(upto).join(now, "bucket", "full")
        same = F.col("n_rows").eqNullSafe(F.col("rows_now")) & F.col("print").eqNullSafe(F.col("print_now"))
        return both.where(~same).select("bucket", "n_rows", "rows_now")

    def compact(self) -> None:
        for table in (self.index, self.sums, self.keys):
            table.compact()

    def expire(self) -> None:
        for table in (self.index, self.sums, self.keys):
            table.expire()
