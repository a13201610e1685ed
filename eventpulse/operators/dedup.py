"""One row per event id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOG_ORDER = ("kafka_partition", "kafka_offset")


def dedup_batch(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """The first arrival of each id.

    ``row_number() = 1`` keeps one row per id on the map side already (Spark's
    WindowGroupLimit), so an id with very many copies does not reach one task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def dedup_stream(df: DataFrame, delay: str, key: str = "event_id", time: str = "kafka_timestamp") -> DataFrame:
    """Optional pre-filter with state bounded by ``delay``.

    It drops rows later than the watermark and forgets older ids, so it never
    replaces first_unseen() in front of the fact table.
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def dedup_recent(
    df: DataFrame,
    gap: str,
    delay: str | None = None,
    key: str = "event_id",
    time: str = "kafka_timestamp",
    order: tuple[str, ...] = LOG_ORDER,
) -> DataFrame:
    """An id is remembered until ``gap`` has passed since its last arrival, and a hit refreshes it.

    Arrivals of an id that follow each other within ``gap`` are one session window; its
    first arrival goes through, with their number as ``arrivals``. On a stream ``delay``
    is the watermark: a session is passed on once the watermark is behind its end, and
    then leaves the state; until then it is one row of the state store, however often
    the id arrives. Rows behind the watermark are dropped.
    """
    timed = df.withWatermark(time, delay) if delay else df
    place = F.struct(time, *order)
    sessions = timed.groupBy(key, F.session_window(time, gap)).agg(
        F.min_by(F.struct(*df.columns), place).alias("first"), F.count("*").alias("arrivals")
    )
    return sessions.select("first.*", "arrivals")


def drop_seen(batch: DataFrame, stored: DataFrame, key: str = "event_id", keys: DataFrame | None = None) -> DataFrame:
    """D3: the rows of the batch whose key is not stored yet.

    The stored keys are first reduced to those in ``keys`` (by default the batch's
    own), so what is joined to the batch is never larger than that. No broadcast is
    forced: Spark decides by measured size.
    """
    arrived = (batch if keys is None else keys).select(key).distinct()
    known = stored.select(key).join(arrived, key, "left_semi")
    return batch.join(known, key, "left_anti")


def within_keys(stored: DataFrame, batch: DataFrame, key: str = "event_id") -> DataFrame:
    """The stored rows between the batch's smallest and largest key.

    The two bounds become literals that skip row groups of files sorted by the key;
    no key of the batch lies outside, so the answer does not depend on them.
    """
    first, last = batch.agg(F.min(key), F.max(key)).first()
    return stored.where(F.lit(False) if first is None else F.col(key).between(first, last))


def first_unseen(batch: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """The first arrival of each id that ``stored`` does not hold, whatever its date.

    ``batch`` should be persisted, since its keys are read next to its rows. Both
    steps work on the id, so one exchange of the batch's rows serves them.
    """
    return drop_seen(dedup_batch(batch, key), within_keys(stored, batch, key), key, batch)
