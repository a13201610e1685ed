"""A stream without the copies that arrive soon after one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventpulse.operators.dedup import dedup_recent
from eventpulse.session import pin_utc
from eventpulse.sinks.tables import BatchTable
from eventpulse.streaming.ingest import ALL_AVAILABLE
from eventpulse.streaming.stateful import start_stateful


def start_recent(
    rows: DataFrame,
    table: BatchTable,
    checkpoint: str,
    gap: str,
    delay: str,
    trigger: dict[str, object] = ALL_AVAILABLE,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """The first arrival of each session of an id into ``table``; see dedup_recent()."""
    pin_utc(rows.sparkSession)
    return start_stateful(dedup_recent(rows, gap, delay), table, checkpoint, "append", trigger, state_partitions)
