"""First arrival per id, within a batch, in a stream and against stored rows."""

from datetime import date

from pyspark.sql import functions as F

from eventpulse.operators import dedup


def rows(spark, *values):
    return spark.createDataFrame(values, "event_id string, kafka_partition int, kafka_offset long, event_date date")


D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_first_arrival_wins(spark):
    df = rows(spark, ("a", 0, 9, D1), ("a", 0, 3, D2), ("b", 1, 1, D1), ("a", 0, 5, D1))
    found = dedup.dedup_batch(df).collect()
    assert sorted((r.event_id, r.kafka_offset) for r in found) == [("a", 3), ("b", 1)]


def test_one_id_with_a_third_of_all_rows(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
    )
    found = dedup.dedup_batch(df)
    assert found.count() == 200_001
    assert found.where("event_id = 'hot'").first().kafka_offset == 0


def test_hot_ids_shrink_before_the_shuffle(spark):
    plan = dedup.dedup_batch(rows(spark, ("a", 0, 1, D1)))._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[shuffle:]


def test_drop_seen(spark):
    batch = rows(spark, ("a", 0, 1, D1), ("b", 0, 2, D1), ("c", 0, 3, D2), ("c", 0, 4, D2))
    stored = rows(spark, ("a", 0, 0, D1), ("z", 0, 0, D1), ("b", 0, 0, D2))
    assert sorted(r.event_id for r in dedup.drop_seen(batch, stored).collect()) == ["c", "c"]
    assert dedup.drop_seen(batch, stored.limit(0)).count() == 4


def test_first_unseen_over_all_dates(spark):
    batch = rows(spark, ("a", 0, 1, D1), ("b", 0, 2, D1), ("b", 1, 0, D2), ("c", 1, 1, D2))
    stored = rows(spark, ("a", 0, 0, D2), ("0", 0, 1, D1), ("z", 0, 2, D1))
    found = dedup.first_unseen(batch, stored).collect()
    assert sorted((r.event_id, r.kafka_partition) for r in found) == [("b", 0), ("c", 1)]
    assert dedup.first_unseen(batch.limit(0), stored).count() == 0
    assert dedup.first_unseen(batch, stored.limit(0)).count() == 3


def test_stored_keys_outside_the_batch_are_skipped(spark):
    batch = rows(spark, ("b", 0, 1, D1), ("d", 0, 2, D1))
    stored = rows(spark, *[(key, 0, 0, D2) for key in "abcde"])
    assert sorted(r.event_id for r in dedup.within_keys(stored, batch).collect()) == ["b", "c", "d"]
    assert dedup.within_keys(stored, batch.limit(0)).count() == 0
