"""Streams with state, written batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventpulse.functions import at_rest
from eventpulse.sinks.tables import BatchTable

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def start_stateful(
    rows: DataFrame,
    table: BatchTable,
    checkpoint: str,
    mode: str,
    trigger: dict[str, object],
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Each micro-batch of ``rows`` becomes a batch of ``table``, so a repeated one converges.

    Every batch commits each partition of the state. ``state_partitions`` sets their
    number for a new checkpoint, by default the session's shuffle partitions; a restart
    keeps what the checkpoint has.
    """
    spark = rows.sparkSession
    partitions = spark.conf.get(SHUFFLE_PARTITIONS)
    writer = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: table.write(at_rest(batch), batch_id))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    spark.conf.set(SHUFFLE_PARTITIONS, str(state_partitions or partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, partitions)
