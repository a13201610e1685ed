"""Log messages to classified, flat event rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions import at_rest, event_time, json_text, record_status
from eventpulse.schemas import EVENT, FACT_COLUMNS


def project_envelope(log: DataFrame) -> DataFrame:
    """S3, P10: the message text with its position in the log."""
    return log.select(
        json_text("value"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def spread(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt evenly to ``partitions`` tasks, for a source with fewer splits than cores; None leaves them.

    Parsing is the dear step, so dealing out pays for a small number of large files that
    Spark can't split. Large sources have splits enough.
    """
    return messages if partitions is None else messages.repartition(partitions)


def parse_once(df: DataFrame, schema, json: str = "json") -> DataFrame:
    """The fields of the JSON text as columns, parsed once per row.

    A plain ``from_json`` column is inlined by the optimizer into every filter
    and projection above it, so each record would be parsed many times. The
    output of a generator is not inlined.
    """
    return df.select("*", F.inline(F.array(F.from_json(json, schema))))


def classify(messages: DataFrame) -> DataFrame:
    """Add the parsed fields, the event time and the record's status."""
    parsed = parse_once(messages, EVENT).withColumn("event_created_at", event_time("created_at"))
    return parsed.withColumn("status", record_status("json"))


def flatten(classified: DataFrame, *extra: str | Column) -> DataFrame:
    """The fact columns of classified records, whatever their status."""
    return classified.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        "event_created_at",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        *extra,
    )


def good_rows(classified: DataFrame) -> DataFrame:
    """Only rows that satisfy the fact table's NOT NULL columns, as stored."""
    return at_rest(flatten(classified.where(F.col("status") == "ok"))).select(FACT_COLUMNS)


def rejected_rows(classified: DataFrame) -> DataFrame:
    """K7: every other record with its raw text and position."""
    return at_rest(
        classified.where(F.col("status") != "ok").select(
            "status", "json", "kafka_partition", "kafka_offset", "kafka_timestamp"
        )
    )


def status_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status").agg(F.count("*").alias("record_count"))


def type_violations(classified: DataFrame) -> DataFrame:
    """C4: leaves that hold a value of the wrong type, one row per record and leaf.

    The typed parse turns such a leaf alone into NULL. The raw text is read
    again only for the records that have a NULL leaf.
    """

    def wrong(typed: str, path: str):
        return F.when(
            F.col(typed).isNull() & F.get_json_object("json", path).isNotNull(), F.lit(typed)
        )

    leaves = F.array_compact(F.array(wrong("actor.id", "$.actor.id"), wrong("repo.id", "$.repo.id")))
    return classified.where(
        F.col("status").isin("ok", "bad_timestamp")
        & (F.col("actor.id").isNull() | F.col("repo.id").isNull())
    ).select(F.col("id").alias("event_id"), "kafka_offset", F.explode(leaves).alias("leaf"))
