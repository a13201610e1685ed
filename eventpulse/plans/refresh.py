"""Batch refreshes: rollups and dimensions from one snapshot of the fact table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.operators.dims import build_actors, build_repos, upsert_dim
from eventpulse.operators.rollups import actor_activity, event_types, events_per_minute, repo_activity
from eventpulse.plans.lake import Lake
from eventpulse.sinks.jdbc import overwrite_table


def run_time(spark: SparkSession) -> datetime:
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]


def all_rollups(fact: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """A1 to A4 with one stamp. Each reads a single column, so four narrow scans are cheap."""
    return {
        "minute": events_per_minute(fact),
        "types": event_types(fact, as_of),
        "repo_activity": repo_activity(fact, as_of),
        "actor_activity": actor_activity(fact, as_of),
    }


def publish_rollups(lake: Lake, fact: DataFrame, as_of: datetime | None = None) -> dict[str, int]:
    """A new version of every rollup, all with the same stamp, which readers of ``lake.rollup_set`` see together."""
    return lake.rollup_set.publish(all_rollups(fact, as_of or run_time(lake.spark)))


def refresh_rollups(lake: Lake, upto: int | None = None, as_of: datetime | None = None) -> dict[str, int]:
    """K2 from the stored fact table, up to a batch.

    The snapshot is fixed once, so the four tables agree while a stream appends.
    """
    return publish_rollups(lake, lake.fact.read(upto), as_of)


def refresh_rollups_jdbc(
    fact: DataFrame,
    url: str,
    tables: dict[str, str],
    properties: dict[str, str],
    as_of: datetime | None = None,
) -> None:
    """K2 into a database; ``tables`` maps rollup names to table names.

    ``fact`` may itself be a database scan, so the four columns are read once.
    """
    columns = fact.select("event_created_at", "event_type", "repo_name", "actor_login").persist()
    try:
        stamp = as_of or run_time(fact.sparkSession)
        for name, df in all_rollups(columns, stamp).items():
            overwrite_table(df, url, tables[name], properties, key=df.columns[0])
    finally:
        columns.unpersist()


def refresh_dims(lake: Lake, batch_id: int | None = None, side: DataFrame | None = None) -> dict[str, int]:
    """M1, M2: publish dimensions rebuilt from the whole fact table, or upserted with one batch.

    An upsert rewrites the buckets that the batch changes. Either way readers of
    ``lake.dim_set`` see both dimensions change together.
    """
    events = lake.fact.read() if batch_id is None else lake.fact.read_batch(batch_id)
    frames = {"repos": build_repos(events, side), "actors": build_actors(events)}
    if batch_id is None:
        return lake.dim_set.publish(frames)
    base = lake.dim_set.versions()
    return lake.dim_set.commit({name: lake.dim_set.tables[name].upsert(df, upsert_dim, base.get(name)) for name, df in frames.items()})
