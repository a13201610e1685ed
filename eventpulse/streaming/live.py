"""Events per minute while they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventpulse.operators.rollups import EVENT_COUNT, events_per_minute
from eventpulse.schemas import MINUTE
from eventpulse.session import pin_utc
from eventpulse.sinks.tables import BatchTable
from eventpulse.streaming.ingest import ALL_AVAILABLE
from eventpulse.streaming.stateful import start_stateful


def _newest(counts: DataFrame) -> DataFrame:
    """A minute's running count only grows, so its newest value is its largest."""
    return counts.groupBy("minute").agg(F.max(EVENT_COUNT).alias(EVENT_COUNT))


def minute_table(spark, path: str) -> BatchTable:
    return BatchTable(spark, path, MINUTE, merge=_newest)


def live_minutes(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Running count per minute of event time (a TIMESTAMP column).

    State is one row per minute. With ``delay``, minutes older than the
    watermark leave the state and later rows for them are dropped; without it
    every row counts, however late.
    """
    if delay:
        events = events.withWatermark("event_created_at", delay)
    return events_per_minute(events)


def start_live_minutes(
    events: DataFrame,
    table: BatchTable,
    checkpoint: str,
    delay: str | None = None,
    mode: str = "update",
    trigger: dict[str, object] = ALL_AVAILABLE,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """``update`` writes the minutes each batch changed; ``append`` only final ones.

    ``state_partitions`` is that of start_stateful().
    """
    pin_utc(events.sparkSession)
    counts = live_minutes(events, delay)
    return start_stateful(counts, table, checkpoint, mode, trigger, state_partitions)


def current_minutes(table: BatchTable) -> DataFrame:
    return _newest(table.read())
