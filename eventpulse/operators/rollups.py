"""Event counts by minute, type, repository, actor and owner."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions import minute_start, repo_owner

EVENT_COUNT = "event_count"

# Grouping column of each rollup; ``minute`` is derived from the event time.
ROLLUP_KEYS = {
    "minute": "minute",
    "types": "event_type",
    "repo_activity": "repo_name",
    "actor_activity": "actor_login",
}


def _count() -> Column:
    return F.count("*").alias(EVENT_COUNT)


def _stamp(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, NULL being a key. Partial counts keep hot keys off the shuffle."""
    return df.groupBy(key).agg(_count())


def events_per_minute(fact: DataFrame) -> DataFrame:
    """Rows per minute of event time, only for minutes that have any."""
    return (
        fact.groupBy(F.window("event_created_at", "1 minute"))
        .agg(_count())
        .select(minute_start(), EVENT_COUNT)
    )


def event_types(fact: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """A2, P9."""
    return count_by(fact, "event_type").withColumn("last_updated", _stamp(as_of))


def repo_activity(fact: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """A3, P9."""
    return count_by(fact, "repo_name").withColumn("last_updated", _stamp(as_of))


def actor_activity(fact: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """A4, P9."""
    return count_by(fact, "actor_login").withColumn("last_updated", _stamp(as_of))


def owner_activity(fact: DataFrame) -> DataFrame:
    """Counted by name first, so names are split once per repository."""
    per_repo = count_by(fact, "repo_name")
    return (
        per_repo.withColumn("repo_owner", repo_owner("repo_name"))
        .groupBy("repo_owner")
        .agg(F.sum(EVENT_COUNT).alias(EVENT_COUNT))
    )


def all_counts(fact: DataFrame) -> dict[str, DataFrame]:
    """The counts of every rollup, without a stamp."""
    return {
        name: events_per_minute(fact) if name == "minute" else count_by(fact, key)
        for name, key in ROLLUP_KEYS.items()
    }


def partial_counts(fact: DataFrame) -> DataFrame:
    """The additive part of every rollup for one batch, as one table.

    A single job then writes them all, so the rollups of a batch appear together.
    """
    columns = {"minute": "timestamp_ntz", "key": "string"}
    parts = []
    for name, counts in all_counts(fact).items():
        key, stored = ROLLUP_KEYS[name], "minute" if name == "minute" else "key"
        keys = [F.col(key).alias(c) if c == stored else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
        parts.append(counts.select(F.lit(name).alias("rollup"), *keys, EVENT_COUNT))
    return reduce(DataFrame.unionAll, parts)


def add_up(partials: DataFrame) -> DataFrame:
    """Partial counts of any number of batches to one count per key."""
    return partials.groupBy("rollup", "minute", "key").agg(F.sum(EVENT_COUNT).alias(EVENT_COUNT))


def rollup_totals(partials: DataFrame, name: str) -> DataFrame:
    """One rollup from its partial counts."""
    stored = "minute" if name == "minute" else "key"
    return (
        partials.where(F.col("rollup") == name)
        .groupBy(F.col(stored).alias(ROLLUP_KEYS[name]))
        .agg(F.sum(EVENT_COUNT).alias(EVENT_COUNT))
    )
