"""M4, M5: lookups on one layout, with the files they open."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventpulse.plans import fixtures
from eventpulse.session import work_dir
from eventpulse.sinks.files import numbered
from eventpulse.sinks.clustered import ClusteredTable, curve_place, slice_bounds
from eventpulse.sources.scans import scan_range

LOOKUPS = ["repo_name", "actor_login", "event_type", "event_created_at"]
ASKED = [
    {"repo_name": "org5/repo5"},
    {"actor_login": "user12"},
    {"event_type": "click"},
    {"start": datetime(2024, 1, 10), "end": datetime(2024, 1, 11)},
    {"repo_name": "org6/repo13", "start": datetime(2024, 1, 5), "end": datetime(2024, 1, 9)},
    {"actor_login": "nobody"},
    {"repo_id": 5},
]


@pytest.fixture(scope="module")
def facts(spark):
    return fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def table(spark, facts):
    table = ClusteredTable(spark, work_dir(spark, "clustered"), facts.schema, LOOKUPS, file_rows=25)
    table.publish(facts)
    return table


@pytest.mark.parametrize("asked", ASKED, ids=lambda a: "+".join(a))
def test_a_lookup_opens_few_files(facts, table, asked):
    every = len(table.files())
    assert 350 <= every <= 400
    found = table.lookup(**asked)
    assert sorted(r.event_id for r in found.collect()) == sorted(r.event_id for r in scan_range(facts, **asked).collect())
    opened = len(found.inputFiles())
    if "repo_id" not in asked:  # not a column of the layout
        assert opened <= 0.5 * every, (opened, every)


def test_rows_are_all_there(facts, table):
    assert sorted(r.event_id for r in table.read().select("event_id").collect()) == sorted(r.event_id for r in facts.select("event_id").collect())


def test_slices_and_places(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(256)], "a int, b int")
    bounds = {"a": slice_bounds(df, "a"), "b": slice_bounds(df, "b")}
    assert len(bounds["a"]) == 15 and bounds["b"] == [0, 1]
    rows = df.select("a", "b", curve_place(bounds).alias("p")).collect()
    for r in rows:
        x = sum(r.a > t for t in bounds["a"])
        y = sum((r.b or 0) > t for t in bounds["b"]) * 16 // 3
        assert r.p == sum((x >> k & 1) << (2 * k + 1) | (y >> k & 1) << (2 * k) for k in range(4))


def test_a_hot_value_is_spread_and_nulls_are_kept(spark):
    rows = [(f"e{i}", "hot" if i % 3 else f"r{i % 50}", None if i % 7 else f"u{i}", "t", datetime(2024, 1, 1 + i % 20)) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id string, repo_name string, actor_login string, event_type string, event_created_at timestamp_ntz")
    table = ClusteredTable(spark, work_dir(spark, "hot"), df.schema, LOOKUPS, file_rows=200)
    table.publish(df)
    sizes = [r[0] for r in table.read().groupBy(F.col("_metadata.file_name")).count().select("count").collect()]
    assert max(sizes) <= 800 and sum(sizes) == 3000
    assert table.lookup(repo_name="hot").count() == 2000 and table.lookup(actor_login="u7").count() == 1
    table.publish(df.limit(5))
    assert table.read().count() == 5
    table.publish(df.limit(7))
    table.expire(keep=1)
    assert table.read().count() == 7 and numbered(spark, f"{table.path}/data", "version") == [2]
    table.publish(df.limit(0))
    assert table.read().count() == 0


def test_files_of_a_large_table_stay_few():
    from eventpulse.sinks.clustered import FILE_ROWS, SMALL_FILES, file_count

    assert [file_count(n, 256) for n in (0, 256, 257, 36_000_000)] == [1, 1, 2, SMALL_FILES]
    assert file_count(10**10, 256) == file_count(10**10, FILE_ROWS) == 10**4
