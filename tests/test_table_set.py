"""K2: tables that are refreshed together, with writers that die on the way."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.plans import fixtures
from eventpulse.plans.lake import Lake
from eventpulse.plans.refresh import publish_rollups, refresh_dims, refresh_rollups
from eventpulse.session import work_dir
from eventpulse.sinks.tables import TableSet, VersionedTable
from tests.test_tables import content, frame, unfinish

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
NAMES = ("a", "b", "c")


@pytest.fixture
def tables(spark):
    root = work_dir(spark, "set")
    return TableSet(spark, root, {name: VersionedTable(spark, f"{root}/{name}", SCHEMA) for name in NAMES})


def refresh(spark, tables, value):
    return tables.publish({name: frame(spark, x=value) for name in NAMES})


def values(tables):
    return {name: [v for _, v in content(df)] for name, df in tables.read().items()}


class Died(Exception):
    pass


def dies(*_):
    raise Died


def test_readers_see_one_refresh(spark, tables, monkeypatch):
    assert values(tables) == {name: [] for name in NAMES}
    refresh(spark, tables, 1)
    assert values(tables) == {name: [1] for name in NAMES}
    # a writer dies after each of the tables, and before the manifest
    for victim in (*(tables.tables[name] for name in NAMES), tables.manifest):
        with monkeypatch.context() as patch:
            patch.setattr(victim, "publish", dies)
            with pytest.raises(Died):
                refresh(spark, tables, 9)
        assert values(tables) == {name: [1] for name in NAMES}
    assert content(tables.tables["a"].read()) == [("x", 9)]
    refresh(spark, tables, 2)
    assert values(tables) == {name: [2] for name in NAMES}
    # a manifest that was not finished does not count
    unfinish(f"{tables.manifest.path}/version={tables.manifest.versions()[-1]}")
    assert values(tables) == {name: [1] for name in NAMES}


def test_expiry_keeps_what_manifests_name(spark, tables, monkeypatch):
    for value in (1, 2, 3):
        refresh(spark, tables, value)
    for _ in range(3):
        with monkeypatch.context() as patch:
            patch.setattr(tables.tables["c"], "publish", dies)
            with pytest.raises(Died):
                refresh(spark, tables, 9)
    tables.expire(keep=2)
    assert values(tables) == {name: [3] for name in NAMES}
    assert len(tables.manifest.versions()) == 2
    # versions of unfinished refreshes are newer than the newest manifest and stay until the next one
    assert tables.tables["a"].versions() == [1, 2, 3, 4, 5] and tables.tables["c"].versions() == [1, 2]
    refresh(spark, tables, 4)
    tables.expire(keep=1)
    assert [tables.tables[name].versions() for name in NAMES] == [[6], [6], [3]]
    assert values(tables) == {name: [4] for name in NAMES}


def test_a_refresh_is_whole(spark, tables):
    with pytest.raises(ValueError, match="needs all"):
        tables.publish({"a": frame(spark, x=1)})
    assert tables.manifest.versions() == []


def test_rollups_and_dimensions_of_the_lake(spark, monkeypatch):
    lake = Lake(spark, work_dir(spark, "lake-set"))
    facts = fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001")).withColumn("event_date", F.to_date("event_created_at"))
    lake.fact.write(facts.where("kafka_offset < 400"), 0)
    refresh_rollups(lake)
    refresh_dims(lake, 0)
    lake.fact.write(facts.where("kafka_offset >= 400"), 1)
    monkeypatch.setattr(lake.rollups["actor_activity"], "publish", dies)
    monkeypatch.setattr(lake.actors, "publish", dies)
    for write in (refresh_rollups, refresh_dims):
        with pytest.raises(Died):
            write(lake)
    monkeypatch.undo()

    def totals():
        return {name: df.agg(F.sum("event_count")).first()[0] for name, df in lake.rollup_set.read().items()}

    old = facts.where("kafka_offset < 400").count()
    assert set(totals().values()) == {old}
    dims = lake.dim_set.read()
    assert dims["repos"].count() == facts.where("kafka_offset < 400").select("repo_id").distinct().count()
    publish_rollups(lake, lake.fact.read())
    refresh_dims(lake, 1)
    assert set(totals().values()) == {facts.count()}
    assert lake.dim_set.read()["actors"].count() == facts.select("actor_id").distinct().count()
    lake.expire()
    assert set(totals().values()) == {facts.count()}
