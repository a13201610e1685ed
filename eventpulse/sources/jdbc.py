"""Database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A whole table; with a numeric, date or timestamp column and its bounds, read in parallel.

    Bounds only set the partition stride: rows outside them are read as well.
    """
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None or partitions is None:
        raise ValueError("a partitioned scan needs bounds and a number of partitions")
    lower, upper = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )
