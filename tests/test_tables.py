"""Batch tables and versioned tables: replay, snapshots, unfinished writes, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.session import work_dir
from eventpulse.sinks.tables import BatchTable, VersionedTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def frame(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def unfinish(path):
    """What a job leaves behind that died while it was committing."""
    os.rename(f"{path}/_SUCCESS", f"{path}/_unfinished")


@pytest.fixture
def table(spark):
    return BatchTable(spark, work_dir(spark, "batch_table"), SCHEMA)


def test_empty(table):
    assert table.read().collect() == []
    assert table.last_batch() is None
    assert table.compact() is None


def test_replay_replaces(spark, table):
    table.write(frame(spark, a=1), 0)
    table.write(frame(spark, b=2, c=3), 1)
    table.write(frame(spark, b=2), 1)
    assert content(table.read()) == [("a", 1), ("b", 2)]
    assert content(table.read_batch(1)) == [("b", 2)]


def test_snapshot_ignores_later_batches(spark, table):
    for i in range(3):
        table.write(frame(spark, a=i), i)
    assert content(table.read(upto=1)) == [("a", 0), ("a", 1)]
    assert content(table.read(upto=-1)) == []


def test_unfinished_batch_is_not_read(spark, table):
    table.write(frame(spark, a=1), 0)
    table.write(frame(spark, b=1), 1)
    unfinish(f"{table._batches}/batch_id=1")
    assert content(table.read()) == [("a", 1)]
    assert table.last_batch() == 0


def test_compaction_keeps_rows_and_the_newest_batch(spark, table):
    for i in range(6):
        table.write(frame(spark, **{f"k{i}": i}), i)
        if i in (2, 4):
            assert table.compact() == i - 1
        assert content(table.read()) == [(f"k{j}", j) for j in range(i + 1)]
    table.write(frame(spark, k5=5), 5)
    assert content(table.read()) == [(f"k{j}", j) for j in range(6)]
    assert table.compactions() == [1, 3]
    assert content(table.read(upto=2)) == [(f"k{j}", j) for j in range(3)]


def test_a_compacted_batch_is_not_written_again(spark, table):
    for i in range(3):
        table.write(frame(spark, **{f"k{i}": i}), i)
    table.compact()
    with pytest.raises(ValueError, match="compaction up to 1"):
        table.write(frame(spark, x=9), 1)
    assert content(table.read()) == [("k0", 0), ("k1", 1), ("k2", 2)]


def test_failed_compaction_is_not_read(spark, table):
    for i in range(3):
        table.write(frame(spark, **{f"k{i}": i}), i)
    table.compact()
    unfinish(f"{table._compacted}/upto=1")
    assert content(table.read()) == [("k0", 0), ("k1", 1), ("k2", 2)]
    table.write(frame(spark, k3=3), 3)
    assert table.compact() == 2
    assert content(table.read()) == [("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)]


def test_expiry_keeps_the_rows(spark, table):
    for i in range(6):
        table.write(frame(spark, **{f"k{i}": i}), i)
        if i in (2, 4):
            table.compact()
    table.expire()
    assert table.batches() == [2, 3, 4, 5]
    assert content(table.read()) == [(f"k{j}", j) for j in range(6)]
    assert content(table.read(upto=2)) == [(f"k{j}", j) for j in range(3)]
    with pytest.raises(ValueError):
        table.read(upto=0)


def test_compaction_merges(spark):
    def add(df):
        return df.groupBy("k").agg(F.sum("v").alias("v"))

    table = BatchTable(spark, work_dir(spark, "merged"), SCHEMA, merge=add)
    rng = random.Random(1)
    expected = {}
    for i in range(5):
        values = {key: rng.randrange(9) for key in "abc"}
        table.write(frame(spark, **values), i)
        for key, value in values.items():
            expected[key] = expected.get(key, 0) + value
    assert table.compact() == 3
    assert len(table.read().collect()) == 6
    assert dict(content(add(table.read()))) == expected


def test_partitioned_empty_batch(spark):
    table = BatchTable(spark, work_dir(spark, "parted"), SCHEMA, partition_by=["k"], sort_by=["v"])
    table.write(frame(spark), 0)
    assert content(table.read()) == []
    table.write(frame(spark, a=1, b=2), 1)
    assert content(table.read()) == [("a", 1), ("b", 2)]


def test_versions(spark):
    table = VersionedTable(spark, work_dir(spark, "versions"), SCHEMA)
    assert content(table.read()) == []
    assert table.publish(frame(spark, a=1)) == 0
    before = table.read()
    assert table.publish(frame(spark, a=2)) == 1
    assert content(before) == [("a", 1)]
    assert content(table.read()) == [("a", 2)]
    unfinish(f"{table.path}/version=1")
    assert content(table.read()) == [("a", 1)]
    assert table.publish(frame(spark, a=3)) == 2
    assert table.publish(frame(spark, a=4)) == 3
    table.expire()
    assert content(table.read()) == [("a", 4)]
    assert not os.path.exists(f"{table.path}/version=0".removeprefix("file:"))
