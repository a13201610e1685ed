"""The database jobs, with Parquet folders in place of database tables."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from eventpulse.plans import fixtures
from eventpulse.plans.refresh import refresh_rollups_jdbc
from eventpulse.schemas import FACT
from eventpulse.session import work_dir
from eventpulse.sinks.jdbc import jdbc_writer
from eventpulse.sources.log import read_log_files
from eventpulse.streaming.ingest import start_jdbc_ingest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, monkeypatch):
    """Folder of the stand-in tables, and the queries that were asked."""
    root, asked = work_dir(spark, "tables"), []

    def read(self, url, table, properties=None):
        asked.append(table)
        if not os.path.isdir(f"{url}/fact".removeprefix("file:")):
            return spark.createDataFrame([], FACT).select("event_id")
        return spark.read.schema(FACT).parquet(f"{url}/fact").select("event_id")

    def write(self, url, table, properties=None):
        self.parquet(f"{url}/{table}")

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return root, asked


def test_stream_into_a_table_and_refresh(spark, tables):
    root, asked = tables
    messages = fixtures.raw_messages(fixtures.redelivered(fixtures.fact(fixtures.source(spark, SMALL))))
    again = F.col("kafka_partition") == 1
    for wave in (messages.where(~again), messages.where(again)):
        fixtures.envelopes(wave).coalesce(1).write.mode("append").parquet(f"{root}/log")
        log = read_log_files(spark, f"{root}/log")
        start_jdbc_ingest(log, root, "fact", {}, f"{root}/checkpoint").awaitTermination()
    fact = spark.read.schema(FACT).parquet(f"{root}/fact")
    expected = messages.where("n % 97 <> 0 and n % 89 <> 0 and n % 83 <> 0 and kafka_partition = 0")
    assert sorted(r.kafka_offset for r in fact.collect()) == sorted(r.n for r in expected.collect())
    assert len(asked) == 2 and "BETWEEN '2024-01-01" in asked[0]

    names = {n: f"gold_{n}" for n in ("minute", "types", "repo_activity", "actor_activity")}
    for _ in range(2):
        refresh_rollups_jdbc(fact, root, names, {})
    for name, table in names.items():
        rows = spark.read.parquet(f"{root}/{table}")
        stored = fact.where("repo_name is not null") if name == "repo_activity" else fact
        assert rows.agg(F.sum("event_count")).first()[0] == stored.count()
        assert ("last_updated" in rows.columns) == (name != "minute")


@pytest.mark.parametrize("key", ["{}", "B-{}"])
def test_an_id_with_another_time_in_a_later_batch(spark, monkeypatch, key):
    root, asked = work_dir(spark, "tables"), []
    batches = [[(9, "2024-01-01"), (100, "2024-01-05")], [(9, "2024-03-01"), (10, "2024-03-02")], [(100, "2023-12-01"), (99, "2024-03-03")]]

    def read(self, url, table, properties=None):
        asked.append(table)
        return spark.sql(f"SELECT * FROM {table}")

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, properties=None: self.parquet(f"{url}/{table}"))
    shape = "event_id string, event_created_at timestamp, kafka_partition int, kafka_offset long"
    spark.createDataFrame([], shape).write.parquet(f"{root}/fact")
    write = jdbc_writer(root, "fact", {})
    for n, rows in enumerate(batches):
        spark.read.parquet(f"{root}/fact").createOrReplaceTempView("fact")
        batch = spark.createDataFrame([(key.format(i), t, 0, k) for k, (i, t) in enumerate(rows)], "event_id string, t string, kafka_partition int, kafka_offset long")
        write(batch.withColumn("t", F.col("t").cast("timestamp")).withColumnRenamed("t", "event_created_at"), n)
    stored = spark.read.parquet(f"{root}/fact").collect()
    assert sorted((r.event_id, str(r.event_created_at)[:10]) for r in stored) == sorted(
        (key.format(i), t) for i, t in [(9, "2024-01-01"), (100, "2024-01-05"), (10, "2024-03-02"), (99, "2024-03-03")]
    )
    assert all(("BETWEEN" in query) == (key == "{}") for query in asked)
