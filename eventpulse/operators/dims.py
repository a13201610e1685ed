"""Dimension tables, normalised events and the star join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.schemas import ACTORS, REPOS

NEWEST = ("event_created_at", "kafka_partition", "kafka_offset")


def _newest(events: DataFrame) -> Column:
    """Event time, then place in the log; offsets compare within a partition only."""
    return F.struct(*[name for name in NEWEST if name in events.columns])


def _latest(value: str, order: Column) -> Column:
    """The newest known value: rows where it is NULL do not count."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), order)).alias(value)


def _typed(df: DataFrame, schema) -> DataFrame:
    """The columns of ``schema``, NULL where ``df`` has no source for one."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def build_repos(events: DataFrame, side: DataFrame | None = None) -> DataFrame:
    """M1: newest known name and url per repository, with its newest event time.

    ``side`` may supply ``language`` and ``stars`` by ``repo_id``; events do not carry them.
    """
    order = _newest(events)
    known = [name for name in ("repo_name", "repo_url") if name in events.columns]
    repos = (
        events.where(F.col("repo_id").isNotNull())
        .groupBy("repo_id")
        .agg(*[_latest(name, order) for name in known], F.max("event_created_at").alias("last_updated"))
    )
    if side is not None:
        repos = repos.join(side.select("repo_id", "language", "stars"), "repo_id", "left")
    return _typed(repos, REPOS)


def build_actors(events: DataFrame) -> DataFrame:
    """M2: newest known login per actor."""
    actors = (
        events.where(F.col("actor_id").isNotNull())
        .groupBy("actor_id")
        .agg(_latest("actor_login", _newest(events)))
        .withColumnRenamed("actor_login", "login")
    )
    return _typed(actors, ACTORS)


def upsert_dim(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """M1, M2: rows of both by key; the value of the row with the newer event wins unless it is NULL.

    Rows are ordered by ``last_updated``, then new before old, so a late batch does
    not undo a newer name. A table without that column takes the new value.
    Both sides hold one row per key, so this is a union and one aggregation, and
    the result is to be published as the table's next version.
    """
    values = [name for name in old.columns if name not in (key, "last_updated")]
    timed = "last_updated" in old.columns
    order = F.struct("last_updated", "_generation") if timed else F.col("_generation")
    columns = [_latest(name, order) for name in values]
    if timed:
        columns.append(F.max("last_updated").alias("last_updated"))
    both = old.withColumn("_generation", F.lit(0)).unionByName(new.withColumn("_generation", F.lit(1)))
    return both.groupBy(key).agg(*columns).select(old.columns)


def normalised_events(events: DataFrame, payload: str = "payload") -> DataFrame:
    """M3: the six columns of the events table; ``payload`` is JSON text or already a variant."""
    text = events.schema[payload].dataType.typeName() == "string"
    return events.select(
        "event_id",
        "event_type",
        "repo_id",
        "actor_id",
        F.col("event_created_at").alias("created_at"),
        (F.try_parse_json(payload) if text else F.col(payload)).alias("payload"),
    )


def star(events: DataFrame, repos: DataFrame, actors: DataFrame) -> DataFrame:
    """Every event with its repository and actor, NULL where there is none.

    No broadcast is forced: Spark broadcasts a dimension below its size
    threshold, else it sorts, and splits skewed keys at run time.
    """
    repo_side = repos.select("repo_id", *[c for c in repos.columns if c not in ("repo_id", "last_updated")])
    return events.join(repo_side, "repo_id", "left").join(actors, "actor_id", "left")
