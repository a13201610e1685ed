"""The log into the fact table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventpulse.functions import at_rest, event_date
from eventpulse.operators.dedup import dedup_batch, drop_seen
from eventpulse.operators.enrich import enrich_repo
from eventpulse.operators.metrics import observed
from eventpulse.operators.parse import classify, flatten, good_rows, project_envelope
from eventpulse.operators.rollups import partial_counts
from eventpulse.plans.lake import Lake
from eventpulse.session import pin_utc
from eventpulse.sinks.jdbc import jdbc_writer

ALL_AVAILABLE = {"availableNow": True}


def ingest_rows(log: DataFrame) -> DataFrame:
    """Row-wise part: fact columns and status of each message, raw text of rejected ones only."""
    raw = F.when(F.col("status") != "ok", F.col("json")).alias("json")
    rows = flatten(observed(classify(project_envelope(log))), "status", raw)
    return at_rest(rows).withColumn("event_date", event_date())


def fact_writer(lake: Lake, compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """K3: writes one micro-batch of ingest_rows() to every table of the lake.

    Everything is addressed by the batch id and compared only with earlier
    batches, so a repeated batch ends in the same state. Offsets are committed
    after it returns (D4). No row is dropped for being late (W5).
    ``compact_every`` batches, the ones before are merged. An id is stored once,
    whatever date it comes with: its keys are compared, not its date partition, with
    those stored files whose sketches let one of them through.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            rejected = rows.where(F.col("status") != "ok")
            lake.quarantine.write(rejected, batch_id)

            good = rows.where(F.col("status") == "ok").drop("status", "json")
            known = lake.keys.near(good, upto=batch_id - 1)
            fresh = drop_seen(dedup_batch(good), known, keys=good)
            lake.fact.write(enrich_repo(fresh) if lake.enrich else fresh, batch_id)

            written = lake.fact.read_batch(batch_id)
            lake.keys.write(written, batch_id)
            lake.partials.write(partial_counts(written), batch_id)
            lake.metrics.write(_batch_metrics(rows, written), batch_id)
            if compact_every and batch_id % compact_every == compact_every - 1:
                lake.compact()
        finally:
            rows.unpersist()

    return write


def _batch_metrics(rows: DataFrame, written: DataFrame) -> DataFrame:
    """A5 for one batch: here a record with a bad timestamp is rejected, hence invalid."""
    both = rows.select("status").unionAll(written.select(F.lit("written")))

    def count(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    counts = both.agg(
        (F.count("*") - count("written")).alias("fetched"),
        count("malformed", "missing_required", "bad_timestamp").alias("invalid"),
        count("null_required").alias("errors"),
        (count("ok") - count("written")).alias("duplicates"),
        count("written").alias("published"),
    )
    return counts.withColumn("polls", F.lit(1).cast("bigint"))


def _start(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_ingest(
    log: DataFrame,
    lake: Lake,
    checkpoint: str,
    trigger: dict[str, object] = ALL_AVAILABLE,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """``trigger`` holds the arguments of Spark's trigger(), e.g. ``{"processingTime": "1 minute"}``.

    The batch ids of the checkpoint address the lake's tables, so the two belong together:
    another checkpoint on the same lake is refused.
    """
    pin_utc(log.sparkSession)
    lake.bind(checkpoint)
    query = _start(ingest_rows(log), fact_writer(lake, compact_every), checkpoint, trigger)
    lake.own(checkpoint)
    return query


def start_jdbc_ingest(
    log: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    checkpoint: str,
    trigger: dict[str, object] = ALL_AVAILABLE,
    enrich: bool = False,
) -> StreamingQuery:
    """Good rows of the log into a database table instead of the lake."""
    pin_utc(log.sparkSession)
    rows = good_rows(classify(project_envelope(log)))
    return _start(enrich_repo(rows) if enrich else rows, jdbc_writer(url, table, properties), checkpoint, trigger)
