"""What an ingest run did."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that fail validation before the duplicate check, and those that pass
# it. A null required value is an error of its own; a bad timestamp is published.
INVALID = ("malformed", "missing_required")
PASSED = ("ok", "bad_timestamp")


def _metric_columns() -> list[Column]:
    passed = F.col("status").isin(*PASSED)
    return [
        F.count("*").alias("fetched"),
        F.count_if(F.col("status").isin(*INVALID)).alias("invalid"),
        F.count_if(F.col("status") == "null_required").alias("errors"),
        F.count_if(passed).alias("passed"),
    ]


def ingest_metrics(classified: DataFrame) -> DataFrame:
    """A5: one row; fetched = invalid + errors + duplicates + published."""
    published = F.count_distinct(F.when(F.col("status").isin(*PASSED), F.col("id")))
    return classified.agg(*_metric_columns(), published.alias("published")).select(
        "fetched",
        "invalid",
        "errors",
        (F.col("passed") - F.col("published")).alias("duplicates"),
        "published",
    )


def duplicate_rate(metrics: DataFrame) -> DataFrame:
    """Duplicates per record that passed validation, 0 where none did."""
    checked = F.col("duplicates") + F.col("published")
    return metrics.select(
        F.when(checked == 0, F.lit(0.0)).otherwise(F.col("duplicates") / checked).alias("duplicate_rate")
    )


def observed(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """Live counters in the stream's progress; the metrics table is the exact record."""
    return classified.observe(name, *_metric_columns())
