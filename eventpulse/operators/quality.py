"""Declared constraints as queries for their violations."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.schemas import FACT_NOT_NULL


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and the NULL key."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .where((F.col("row_count") > 1) | F.col(key).isNull())
    )


def key_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """C1 over many tables (name to rows and key): repeated keys and rows with a NULL key in each."""
    found = [
        pk_violations(df, key).agg(
            F.lit(name).alias("table_name"),
            F.count_if(F.col(key).isNotNull()).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("row_count"))), F.lit(0)).alias("null_keys"),
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionAll, found)


def null_violations(df: DataFrame, columns: list[str] = FACT_NOT_NULL) -> DataFrame:
    """One row with the number of NULLs of each column, from one pass."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def orphans(events: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Events whose non-NULL foreign key has no dimension row."""
    return events.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def orphan_counts(events: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Events per missing key. Counting comes first, so the join sees one row per key."""
    per_key = (
        events.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("event_count"))
    )
    return per_key.join(dim.select(key), key, "left_anti")
