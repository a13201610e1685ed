"""P7, T-1 to T-4: the dashboards' queries, on the fact table or on its rollups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.operators.rollups import EVENT_COUNT, count_by, events_per_minute


def ranked(counts: DataFrame, key: str) -> DataFrame:
    """Largest count first; the key breaks ties, so the order is fixed."""
    return counts.orderBy(F.desc(EVENT_COUNT), key)


def leaders(counts: DataFrame, key: str, n: int = 10) -> DataFrame:
    """P7 and top-k on a rollup: each task keeps n rows and no full sort takes place."""
    return ranked(counts.where(F.col(key).isNotNull()).select(key, EVENT_COUNT), key).limit(n)


def type_distribution(fact: DataFrame) -> DataFrame:
    """T-1."""
    return ranked(count_by(fact, "event_type"), "event_type")


def top_repos(fact: DataFrame, n: int = 10) -> DataFrame:
    """T-2."""
    return leaders(count_by(fact, "repo_name"), "repo_name", n)


def top_actors(fact: DataFrame, n: int = 10) -> DataFrame:
    """T-3."""
    return leaders(count_by(fact, "actor_login"), "actor_login", n)


def minute_series(fact: DataFrame) -> DataFrame:
    """T-4."""
    return events_per_minute(fact).orderBy("minute")
