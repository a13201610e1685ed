"""An id is forgotten only when it has not been met for a while."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventpulse.functions import at_rest
from eventpulse.operators.dedup import dedup_recent
from eventpulse.session import work_dir
from eventpulse.sinks.tables import BatchTable
from eventpulse.streaming.recent import start_recent

NOON = datetime(2024, 1, 1, 12)
SCHEMA = "event_id string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp"


def rows(spark, *arrivals):
    """(id, minutes past noon, offset)"""
    values = [(i, 0, offset, NOON + timedelta(minutes=m)) for i, m, offset in arrivals]
    frame = spark.createDataFrame(values, SCHEMA.replace("kafka_timestamp timestamp", "kafka_timestamp timestamp_ntz"))
    return frame.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp"))


def firsts(df):
    return sorted((r.event_id, r.kafka_offset, r.arrivals) for r in df.collect())


def test_a_hit_refreshes(spark):
    # each copy comes within half an hour of the one before, the last one an hour and a half after the first
    found = dedup_recent(rows(spark, ("a", 0, 1), ("a", 25, 2), ("a", 50, 3), ("a", 75, 4), ("a", 90, 5), ("b", 10, 6)), "30 minutes")
    assert firsts(found) == [("a", 1, 5), ("b", 6, 1)]


def test_an_id_is_forgotten_after_the_gap(spark):
    found = dedup_recent(rows(spark, ("a", 0, 1), ("a", 30, 2), ("a", 60.001, 3), ("a", 120, 5), ("a", 121, 4)), "30 minutes")
    assert firsts(found) == [("a", 1, 2), ("a", 3, 1), ("a", 5, 2)]


def test_ties_go_by_place_in_the_log(spark):

    found = dedup_recent(rows(spark, ("a", 0, 7), ("a", 0, 3)), "30 minutes")
    assert firsts(found) == [("a", 3, 2)]


@pytest.mark.parametrize("cuts", [(), (3,), (1, 2, 5), (2, 4, 6)])
def test_a_restart_changes_nothing(spark, cuts):
    arrivals = [("a", 0, 1), ("b", 5, 2), ("a", 20, 3), ("a", 45, 4), ("c", 50, 5), ("a", 90, 6), ("b", 100, 7), ("z", 300, 8)]
    root = work_dir(spark, "recent")
    schema = rows(spark).schema
    table = BatchTable(spark, f"{root}/out", at_rest(rows(spark).withColumn("arrivals", F.lit(0).cast("long"))).schema)
    for low, high in zip((0, *cuts), (*cuts, len(arrivals))):
        rows(spark, *arrivals[low:high]).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        start_recent(stream, table, f"{root}/ck", "30 minutes", "10 minutes", state_partitions=2).awaitTermination()
    # the session of z is still open
    assert firsts(table.read()) == [("a", 1, 3), ("a", 6, 1), ("b", 2, 1), ("b", 7, 1), ("c", 5, 1)]
