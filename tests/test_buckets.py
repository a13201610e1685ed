"""M1, M2: upserts that rewrite the buckets they change."""

import random
from datetime import datetime, timedelta

import pytest

from eventpulse.operators.dims import upsert_dim
from eventpulse.plans import fixtures
from eventpulse.plans.lake import Lake
from eventpulse.plans.refresh import refresh_dims
from eventpulse.schemas import REPOS
from eventpulse.session import work_dir
from eventpulse.sinks.buckets import BucketedTable
from pyspark.sql import functions as F

DAY = datetime(2024, 1, 1)


def rows(spark, *values):
    """(repo_id, name, day)"""
    return spark.createDataFrame([(i, name, None, None, None, DAY + timedelta(days=day)) for i, name, day in values], REPOS)


def content(df):
    return {r.repo_id: (r.repo_name, (r.last_updated - DAY).days) for r in df.collect()}


@pytest.fixture
def table(spark):
    return BucketedTable(spark, work_dir(spark, "buckets"), REPOS, "repo_id", buckets=16)


def rewritten(table, version):
    return [b for b, data in table.pointers(version).items() if data == version]


def test_an_upsert_rewrites_changed_buckets_only(spark, table):
    table.publish(rows(spark, *((i, f"r{i}", 1) for i in range(300))))
    whole = table.pointers()
    assert len(whole) == 16 and table.read().count() == 300
    bucket = {r.repo_id: r.b for r in table.read().select("repo_id", table._bucket().alias("b")).collect()}
    version = table.upsert(rows(spark, (7, "new", 2), (1000, "more", 2), (9, "late", 0), (11, "r11", 1)), upsert_dim)
    of_new = rows(spark, (1000, "x", 0)).select(table._bucket()).first()[0]
    # 9 is older than what is stored and 11 says nothing new, so their buckets stay
    assert sorted(rewritten(table, version)) == sorted({bucket[7], of_new})
    got = content(table.read())
    assert len(got) == 301 and got[7] == ("new", 2) and got[1000] == ("more", 2) and got[9] == ("r9", 1)
    # a repeated batch writes nothing
    assert table.upsert(rows(spark, (7, "new", 2), (1000, "more", 2)), upsert_dim) == version
    assert content(table.read(0)) == {i: (f"r{i}", 1) for i in range(300)}
    written = table.read().inputFiles()
    assert sum(f"/data/version={version}/" in path for path in written) == len(rewritten(table, version))


def test_many_upserts_equal_one(spark, table):
    rng = random.Random(1)
    batches = [[(i, rng.choice([None, f"n{rng.randrange(5)}"]), rng.randrange(40)) for i in rng.sample(range(60), 15)] for _ in range(6)]
    old = rows(spark)
    for batch in batches:
        table.upsert(rows(spark, *batch), upsert_dim)
        old = spark.createDataFrame(upsert_dim(old, rows(spark, *batch), "repo_id").collect(), REPOS)
        assert content(table.read()) == content(old)
    for version in table.versions()[:-2]:
        table.drop(version)
    assert content(table.read()) == content(old) and len(table.versions()) == 2
    # files of dropped versions are gone unless a kept version points to them
    used = {(d, b) for v in table.versions() for b, d in table.pointers(v).items()}
    for path in table.read(table.versions()[0]).inputFiles() + table.read().inputFiles():
        assert any(f"/data/version={d}/bucket={b}/" in path for d, b in used)


def test_null_keys_and_empty_batches(spark, table):
    first = table.upsert(rows(spark), upsert_dim)
    assert content(table.read()) == {} and table.pointers() == {}
    assert table.upsert(rows(spark, (None, "x", 1)), upsert_dim) == first
    table.upsert(rows(spark, (1, "a", 1)), upsert_dim, base=first)
    assert content(table.read()) == {1: ("a", 1)}


def test_an_unfinished_upsert_is_not_read(spark, table, monkeypatch):
    table.publish(rows(spark, (1, "a", 1), (2, "b", 1)))

    def dies(*_):
        raise RuntimeError

    with monkeypatch.context() as patch:
        patch.setattr(table, "_point", dies)
        with pytest.raises(RuntimeError):
            table.upsert(rows(spark, (1, "z", 2)), upsert_dim)
    assert content(table.read()) == {1: ("a", 1), 2: ("b", 1)}
    table.upsert(rows(spark, (1, "c", 3)), upsert_dim)
    assert content(table.read()) == {1: ("c", 3), 2: ("b", 1)}


def test_lake_dimensions_rewrite_few_buckets(spark):
    lake = Lake(spark, work_dir(spark, "lake-buckets"))
    facts = fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001")).withColumn("event_date", F.to_date("event_created_at"))
    lake.fact.write(facts, 0)
    refresh_dims(lake)
    lake.fact.write(facts.where("event_id = 3").withColumn("event_created_at", F.lit(datetime(2025, 1, 1))), 1)
    versions = refresh_dims(lake, 1)
    assert len(rewritten(lake.repos, versions["repos"])) == 1
    newest = lake.dim_set.read()["repos"].where("last_updated >= '2025-01-01'")
    assert newest.count() == 1
    # no login changed, so the actors keep their version
    assert versions["actors"] == lake.actors.versions()[-1] == 0
    lake.expire()
    assert lake.dim_set.read()["repos"].count() == facts.select("repo_id").distinct().count()
