"""Landed API responses, each a JSON array of events, and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def explode_responses(responses: DataFrame, text: str = "value") -> DataFrame:
    """One ``json`` row per event. Elements keep their own text, numbers and key order included.

    A response that is no array becomes one row with its whole text, so that the
    classification can reject it; an empty array has no rows.
    """
    parsed = responses.withColumn("_events", F.from_json(text, "array<string>"))
    texts = F.when(F.col("_events").isNull(), F.array(text)).otherwise(F.col("_events"))
    others = [name for name in responses.columns if name != text]
    return parsed.select(*others, F.explode(texts).alias("json"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Files of one response each. A response is one page of events, so it is read whole."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("response"))
    return explode_responses(files)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Files of one event per line; large files are split between tasks."""
    return spark.read.text(path).withColumnRenamed("value", "json")
