"""Stream ingest under replay, redelivery, restart and disorder; live minutes; late data."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventpulse.operators.dedup import dedup_stream
from eventpulse.operators.quality import pk_violations
from eventpulse.plans import fixtures
from eventpulse.plans.lake import Lake
from eventpulse.plans.refresh import refresh_dims, refresh_rollups
from eventpulse.operators.rollups import ROLLUP_KEYS, all_counts
from eventpulse.schemas import FACT_COLUMNS
from eventpulse.session import work_dir
from eventpulse.sources.log import read_log_files
from eventpulse.streaming.ingest import fact_writer, ingest_rows, start_ingest
from eventpulse.streaming.live import current_minutes, minute_table, start_live_minutes
from eventpulse.streaming.progress import ingest_progress


def valid_messages(spark, sf_dir):
    """One well-formed message per event; ``n`` is the event's number."""
    facts = fixtures.fact(fixtures.source(spark, sf_dir))
    return fixtures.raw_messages(facts.withColumn("n", F.col("kafka_offset"))).where(
        "n % 97 <> 0 and n % 89 <> 0 and n % 83 <> 0"
    )


def land(messages, path):
    """One file, so that one file per trigger is one micro-batch."""
    fixtures.envelopes(messages).coalesce(1).write.mode("append").parquet(path)


def ingest(spark, root, lake, **options):
    log = read_log_files(spark, f"{root}/log", max_files_per_trigger=1)
    query = start_ingest(log, lake, f"{root}/checkpoint", **options)
    query.awaitTermination()
    return query


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


@pytest.fixture(scope="module")
def small(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="module")
def few_state_partitions(spark):
    """Tiny state: two partitions each commit faster than eight."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_restart_redelivery_and_metrics(spark, small):
    root = work_dir(spark, "restart")
    lake = Lake(spark, f"{root}/lake", enrich=True)
    messages = fixtures.raw_messages(fixtures.redelivered(fixtures.fact(fixtures.source(spark, small))))
    again = F.col("kafka_partition") == 1
    land(messages.where(~again), f"{root}/log")
    query = ingest(spark, root, lake)
    assert [p["fetched"] for p in ingest_progress(query) if p.get("fetched")] == [1000]
    first = ids(lake.fact.read())

    land(messages.where(again), f"{root}/log")
    ingest(spark, root, lake)
    fact = lake.fact.read()
    assert ids(fact) == first
    assert fact.where("kafka_partition = 1").count() == 0
    assert fact.where("repo_owner is not null").count() > 0
    assert lake.fact.batches() == [0, 1]

    totals = lake.metrics.read().agg(*[F.sum(c).alias(c) for c in lake.metrics.schema.fieldNames()]).first()
    assert (totals.polls, totals.fetched, totals.published) == (2, 1100, len(first))
    assert totals.fetched == totals.invalid + totals.errors + totals.duplicates + totals.published
    assert lake.quarantine.read().count() == totals.invalid + totals.errors
    assert lake.quarantine.read().where("json is null").count() == 0


def test_arrival_out_of_order_keeps_every_id(spark, small):
    root = work_dir(spark, "disorder")
    lake = Lake(spark, f"{root}/lake")
    messages = valid_messages(spark, small)
    for b in range(5):
        land(messages.where(F.col("n") % 5 == b), f"{root}/log")
    ingest(spark, root, lake, compact_every=2)
    assert lake.fact.batches() == [0, 1, 2, 3, 4]
    assert lake.fact.compactions() == [0, 2]
    lake.expire()
    assert ids(lake.fact.read()) == sorted(str(r.n) for r in messages.select("n").collect())


def test_late_redelivery_is_found_after_compaction(spark, small):
    root = work_dir(spark, "late")
    lake = Lake(spark, f"{root}/lake")
    messages = valid_messages(spark, small)
    for low in (0, 250, 500, 750):
        land(messages.where(F.col("n").between(low, low + 249)), f"{root}/log")
    ingest(spark, root, lake)
    lake.compact()
    assert lake.fact.compactions() == [2]
    late = messages.where("n % 10 = 0").withColumns(
        {
            "kafka_partition": F.lit(1),
            "kafka_timestamp": F.col("kafka_timestamp") + F.expr("interval 31 days"),
        }
    )
    land(late, f"{root}/log")
    ingest(spark, root, lake)
    expected = sorted(str(r.n) for r in messages.select("n").collect())
    assert ids(lake.fact.read()) == expected
    for name, counts in all_counts(lake.fact.read()).items():
        assert sorted(map(repr, counts.collect())) == sorted(map(repr, lake.totals(name).collect()))


def test_an_id_that_returns_on_another_date_is_stored_once(spark, small):
    lake = Lake(spark, work_dir(spark, "dates"))
    write = fact_writer(lake)
    rows = ingest_rows(fixtures.envelopes(valid_messages(spark, small)))
    moved = rows.withColumns(
        {
            "event_created_at": F.col("event_created_at") + F.expr("interval 3 days"),
            "event_date": F.date_add("event_date", 3),
            "kafka_partition": F.lit(1),
        }
    )
    write(rows.where("kafka_offset < 600"), 0)
    write(moved, 1)
    fact = lake.fact.read()
    assert pk_violations(fact, "event_id").count() == 0
    assert fact.count() == rows.count() == lake.keys.read().count()
    assert fact.where("kafka_partition = 1").agg(F.min("kafka_offset")).first()[0] >= 600


def test_another_checkpoint_is_refused(spark, small):
    root = work_dir(spark, "foreign")
    lake = Lake(spark, f"{root}/lake")
    messages = valid_messages(spark, small)
    land(messages.where("n < 500"), f"{root}/log")
    ingest(spark, root, lake)
    stored = ids(lake.fact.read())
    land(messages.where("n >= 500"), f"{root}/other/log")
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest(spark, f"{root}/other", lake)
    assert ids(lake.fact.read()) == stored
    land(messages.where("n >= 500"), f"{root}/log")
    ingest(spark, root, lake)
    assert len(ids(lake.fact.read())) == messages.count()


def test_a_repeated_batch_converges(spark, small):
    lake = Lake(spark, work_dir(spark, "repeat"))
    write = fact_writer(lake)
    rows = ingest_rows(fixtures.envelopes(valid_messages(spark, small)))
    halves = [rows.where("kafka_offset < 600"), rows.where("kafka_offset >= 400")]
    for batch_id in (0, 0, 1, 1):
        write(halves[batch_id], batch_id)
    once = rows.select(FACT_COLUMNS)
    assert sorted(map(repr, lake.fact.read().select(FACT_COLUMNS).collect())) == sorted(map(repr, once.collect()))
    assert lake.metrics.read_batch(1).first().duplicates == once.where("kafka_offset between 400 and 599").count()


def test_rollups_agree_with_the_fact_table(spark, small):
    lake = Lake(spark, work_dir(spark, "agree"))
    write = fact_writer(lake)
    rows = ingest_rows(fixtures.envelopes(valid_messages(spark, small)))
    write(rows.where("kafka_offset < 500"), 0)
    write(rows.where("kafka_offset >= 500"), 1)
    as_of = datetime(2024, 2, 1)
    refresh_rollups(lake, as_of=as_of)
    total = lake.fact.read().count()
    for name, key in ROLLUP_KEYS.items():
        published = lake.rollups[name].read()
        assert published.agg(F.sum("event_count")).first()[0] == total
        if name != "minute":
            assert [r[0] for r in published.select("last_updated").distinct().collect()] == [as_of]
        live = lake.totals(name).select(key, "event_count")
        assert sorted(map(repr, published.select(key, "event_count").collect())) == sorted(map(repr, live.collect()))
    refresh_rollups(lake, upto=0, as_of=as_of)
    assert lake.rollups["types"].read().agg(F.sum("event_count")).first()[0] == lake.fact.read(upto=0).count()


def test_dimensions_by_batch_equal_a_rebuild(spark, small):
    lake = Lake(spark, work_dir(spark, "dims"))
    write = fact_writer(lake)
    rows = ingest_rows(fixtures.envelopes(valid_messages(spark, small)))
    for batch_id, batch in enumerate((rows.where("kafka_offset < 500"), rows.where("kafka_offset >= 500"))):
        write(batch, batch_id)
        refresh_dims(lake, batch_id)
    by_batch = [sorted(map(repr, t.read().collect())) for t in (lake.repos, lake.actors)]
    refresh_dims(lake)
    assert by_batch == [sorted(map(repr, t.read().collect())) for t in (lake.repos, lake.actors)]


def minutes_stream(spark, path, files=1):
    schema = "event_created_at timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def land_times(spark, path, *times):
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    rows.select(F.col("t").cast("timestamp").alias("event_created_at")).coalesce(1).write.mode("append").parquet(path)


NOON = datetime(2024, 1, 1, 12)


def at(minutes, seconds=0.0):
    return NOON + timedelta(minutes=minutes, seconds=seconds)


def live(spark, batches, **options):
    root = work_dir(spark, "live")
    for times in batches:
        land_times(spark, f"{root}/in", *times)
    table = minute_table(spark, f"{root}/minutes")
    start_live_minutes(minutes_stream(spark, f"{root}/in"), table, f"{root}/ck", **options).awaitTermination()
    return {r.minute: r.event_count for r in current_minutes(table).collect()}


# Spark drops late rows by the watermark of the batch before, so the third batch lies between.
BATCHES = [[at(0, 59.999), at(1)], [at(1, 30), at(60)], [at(61)], [at(0, 5), at(0, 6)]]


def test_live_minutes_count_late_rows_without_a_delay(spark):
    assert live(spark, BATCHES) == {at(0): 3, at(1): 2, at(60): 1, at(61): 1}


def test_live_minutes_with_a_delay_drop_rows_behind_it(spark):
    assert live(spark, BATCHES, delay="10 minutes") == {at(0): 1, at(1): 2, at(60): 1, at(61): 1}


def test_state_partitions_are_set_for_the_stream_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    root = work_dir(spark, "state")
    land_times(spark, f"{root}/in", at(0), at(1))
    table = minute_table(spark, f"{root}/minutes")
    query = start_live_minutes(minutes_stream(spark, f"{root}/in"), table, f"{root}/ck", state_partitions=3)
    query.awaitTermination()
    assert query.lastProgress.stateOperators[0].numShufflePartitions == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_append_mode_holds_back_open_minutes(spark):
    assert live(spark, BATCHES, delay="10 minutes", mode="append") == {at(0): 1, at(1): 2}


def test_stream_dedup_forgets_after_its_delay(spark):
    root = work_dir(spark, "dedup_stream")
    schema = "event_id string, kafka_timestamp timestamp"
    batches = (
        [("a", at(0)), ("a", at(1))],
        [("b", at(300)), ("a", at(2))],
        [("d", at(300))],
        [("a", at(301)), ("b", at(301)), ("c", at(0))],
    )
    for batch in batches:
        rows = spark.createDataFrame(batch, schema)
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = (
        dedup_stream(stream, "10 minutes")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/ck")
        .trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    kept = sorted(r.event_id for r in spark.read.parquet(f"{root}/out").collect())
    assert kept == ["a", "a", "b", "d"]
