"""Rollups, leaderboards, metrics and the incremental form under random batches."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventpulse.operators import metrics, rollups
from eventpulse.plans import dashboards
from eventpulse.plans.refresh import all_rollups

SCHEMA = "event_id string, event_type string, event_created_at timestamp_ntz, actor_login string, repo_name string"
T0 = datetime(2024, 1, 1)


def facts(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_minute_edges(spark):
    df = facts(
        spark,
        ("1", "a", datetime(2024, 1, 1, 0, 0, 59, 999000), "x", "r"),
        ("2", "a", datetime(2024, 1, 1, 0, 1), "x", "r"),
        ("3", "a", None, "x", "r"),
    )
    expected = {datetime(2024, 1, 1): 1, datetime(2024, 1, 1, 0, 1): 1}
    assert pairs(rollups.events_per_minute(df)) == expected
    assert [r.minute for r in dashboards.minute_series(df).collect()] == sorted(expected)


def test_minutes_before_the_epoch(spark):
    df = facts(spark, ("1", "a", datetime(1969, 12, 31, 23, 59, 30), "x", "r"))
    assert pairs(rollups.events_per_minute(df)) == {datetime(1969, 12, 31, 23, 59): 1}


def test_null_is_a_group_but_no_leader(spark):
    df = facts(spark, *[(str(i), "a", T0, None, n) for i, n in enumerate(["b", "a", None, None, None, "c", "c"])])
    assert pairs(rollups.repo_activity(df, T0)) == {"a": 1, "b": 1, "c": 2, None: 3}
    assert [tuple(r) for r in dashboards.top_repos(df, 2).collect()] == [("c", 2), ("a", 1)]
    assert dashboards.top_actors(df).collect() == []
    gold = rollups.repo_activity(df, T0)
    assert [r.repo_name for r in dashboards.leaders(gold, "repo_name").collect()] == ["c", "a", "b"]


def test_owner_activity(spark):
    names = ["o/a", "o/b", "solo", None, "/x"]
    df = facts(spark, *[(str(i), "a", T0, "x", n) for i, n in enumerate(names)])
    assert pairs(rollups.owner_activity(df)) == {"o": 2, "solo": 1, None: 1, "": 1}


def test_type_distribution_order(spark):
    df = facts(spark, *[(str(i), t, T0, "x", "r") for i, t in enumerate(["b", "a", "c", "c"])])
    assert [tuple(r) for r in dashboards.type_distribution(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_one_stamp_for_all_rollups(spark):
    df = facts(spark, ("1", "a", T0, "x", "r"))
    tables = all_rollups(df, T0)
    assert "last_updated" not in tables.pop("minute").columns
    assert {t.first().last_updated for t in tables.values()} == {T0}
    assert rollups.event_types(df).first().last_updated is not None


KEYS = st.sampled_from([None, "a", "b", "o/r"])
EVENTS = st.lists(
    st.tuples(KEYS, KEYS, KEYS, st.datetimes(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 5)), st.integers(0, 3)),
    min_size=1,
    max_size=30,
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EVENTS)
def test_any_split_into_batches_adds_up(spark, events):
    rows = [(str(i), kind, time, actor, repo, b) for i, (kind, actor, repo, time, b) in enumerate(events)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, batch int").coalesce(1).cache()
    parts = [rollups.partial_counts(df.where(F.col("batch") == b)) for b in range(4)]
    merged = rollups.add_up(parts[0].unionAll(parts[1])).unionAll(parts[2]).unionAll(parts[3]).coalesce(1)
    for name, full in rollups.all_counts(df).items():
        counted = pairs(full)
        assert pairs(rollups.rollup_totals(merged, name)) == counted
        assert sum(counted.values()) == len(rows)


STATUS_ROWS = [
    (["ok", "ok", "bad_timestamp", "malformed", "missing_required", "null_required"],
     ["1", "1", "2", None, "3", None], (6, 2, 1, 1, 2), 1 / 3),
    ([], [], (0, 0, 0, 0, 0), 0.0),
    (["malformed"], [None], (1, 1, 0, 0, 0), 0.0),
]


@pytest.mark.parametrize("statuses, ids, expected, rate", STATUS_ROWS)
def test_ingest_metrics(spark, statuses, ids, expected, rate):
    df = spark.createDataFrame(list(zip(statuses, ids)), "status string, id string")
    row = metrics.ingest_metrics(df)
    assert tuple(row.first()) == expected
    assert row.first().fetched == sum(expected[1:])
    assert metrics.duplicate_rate(row).first().duplicate_rate == pytest.approx(rate)
