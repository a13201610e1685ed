"""The event log as a stream or a batch of ENVELOPE rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventpulse.schemas import ENVELOPE


def log_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> dict[str, str]:
    """Reader options. ``starting_offsets`` counts only without a checkpoint;
    use ``earliest`` to backfill. ``min_partitions`` splits large topic partitions."""
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in chosen.items() if v is not None} | options


def read_log(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options) -> DataFrame:
    """A Kafka topic. The connector must be on the session's class path."""
    if not streaming:
        options.setdefault("starting_offsets", "earliest")
    reader = spark.readStream if streaming else spark.read
    loaded = reader.format("kafka").options(**log_options(servers, topic, **options)).load()
    return loaded.select(ENVELOPE.fieldNames())


def read_log_files(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Archived log messages in Parquet files with the same columns."""
    if not streaming:
        return spark.read.schema(ENVELOPE).parquet(path)
    limits = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
    chosen = {k: str(v) for k, v in limits.items() if v is not None}
    return spark.readStream.schema(ENVELOPE).options(**chosen).parquet(path)
