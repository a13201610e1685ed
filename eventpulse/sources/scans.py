"""Scans of the fact table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_range(
    fact: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    time: str = "event_created_at",
    **equals: object,
) -> DataFrame:
    """Rows with ``start <= time < end`` and the given column values.

    On a table partitioned by ``event_date`` the range also becomes a partition
    filter; the rest is pushed down to Parquet statistics and dictionaries.
    """
    dated = "event_date" in fact.columns
    if start is not None:
        fact = fact.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
        if dated:
            fact = fact.where(F.col("event_date") >= F.lit(start.date()))
    if end is not None:
        fact = fact.where(F.col(time) < F.lit(end).cast("timestamp_ntz"))
        if dated:
            last = (end - timedelta(microseconds=1)).date()
            fact = fact.where(F.col("event_date") <= F.lit(last))
    for column, value in equals.items():
        fact = fact.where(F.col(column) == F.lit(value))
    return fact
