"""K1, K2, K3, D3: database sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.operators.dedup import dedup_batch, drop_seen


def stored_keys_query(
    table: str, key: str, time: str, first: object, last: object, keys: Sequence[tuple[object, object]] = ()
) -> str:
    """A subquery for the keys in a time range or in a range of ``keys``, evaluated by the database and its indexes."""
    ranges = [(time, first, last), *((key, low, high) for low, high in keys)]
    within = " OR ".join(f"{column} BETWEEN '{low}' AND '{high}'" for column, low, high in ranges)
    return f"(SELECT {key} FROM {table} WHERE {within}) stored_keys"


def all_keys_query(table: str, key: str) -> str:
    return f"(SELECT {key} FROM {table}) stored_keys"


def append_new(batch: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """K6, D3: the rows an append may add without breaking the table's primary key."""
    return drop_seen(dedup_batch(batch, key), stored, key)


def jdbc_writer(
    url: str,
    table: str,
    properties: dict[str, str],
    key: str = "event_id",
    time: str = "event_created_at",
) -> Callable[[DataFrame, int], None]:
    """K1, K3: a micro-batch writer that appends only unknown keys, so a replay adds nothing.

    A key may come back with any event time, so the stored keys between the batch's
    smallest and largest are fetched, apart for each length: digits of one length have
    the same order in Spark and in every database collation. Other keys have not, so a
    batch that holds one reads all stored keys. The keys of the batch's time range are
    fetched besides; the answer does not depend on them. The query runs on the database.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            text = F.col(key).cast("string")
            spans = batch.where(F.col(key).isNotNull()).groupBy(F.length(text)).agg(
                F.min(key).alias("low"), F.max(key).alias("high"), F.min(text.rlike(r"^[0-9]+\z")).alias("digits"),
                F.min(time).alias("first"), F.max(time).alias("last"),
            ).collect()
            if not spans:
                return
            times = [t for s in spans for t in (s["first"], s["last"]) if t is not None]
            if times and all(s["digits"] for s in spans):
                query = stored_keys_query(table, key, time, min(times), max(times), sorted((s["low"], s["high"]) for s in spans))
            else:
                query = all_keys_query(table, key)
            stored = batch.sparkSession.read.jdbc(url, query, properties=properties)
            append_new(batch, stored, key).write.mode("append").jdbc(url, table, properties=properties)
        finally:
            batch.unpersist()

    return write


def overwrite_table(df: DataFrame, url: str, table: str, properties: dict[str, str], key: str | None = None) -> None:
    """K2: full refresh that keeps the table and its constraints; a NULL key cannot be stored."""
    rows = df.where(F.col(key).isNotNull()) if key else df
    rows.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)
