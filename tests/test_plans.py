"""The physical plans that the design relies on."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventpulse.operators import dedup, dims, metrics, rollups
from eventpulse.operators.parse import classify, good_rows, project_envelope
from eventpulse.plans import dashboards, fixtures
from eventpulse.plans.lake import Lake
from eventpulse.session import work_dir
from eventpulse.sources.scans import scan_range


@pytest.fixture(autouse=True, scope="module")
def whole_plan_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lake(spark, work_dir(spark, "plans"))
    facts = fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001"))
    facts = facts.withColumn("event_date", F.to_date("event_created_at"))
    for batch_id in range(2):
        lake.fact.write(facts.where(F.col("kafka_offset") % 2 == batch_id), batch_id)
        lake.keys.write(facts.where(F.col("kafka_offset") % 2 == batch_id), batch_id)
    return lake


def test_each_rollup_reads_one_column(lake):
    columns = {"minute": "event_created_at", "types": "event_type",
               "repo_activity": "repo_name", "actor_activity": "actor_login"}
    for name, df in rollups.all_counts(lake.fact.read()).items():
        read = re.findall(r"ReadSchema: struct<(.*?)>", plan(df))
        assert [r.split(":")[0] for r in read] == [columns[name]]
        assert shuffles(df) == 1
        assert plan(df).index("partial_count") > plan(df).index("Exchange")


def test_leaderboard_keeps_n_rows_per_task_and_pushes_the_null_filter(lake):
    text = plan(dashboards.top_repos(lake.fact.read()))
    assert "TakeOrderedAndProject(limit=10" in text
    assert "PushedFilters: [IsNotNull(repo_name)]" in text


def test_time_range_prunes_partitions_and_pushes_filters(lake):
    found = scan_range(lake.fact.read(), datetime(2024, 1, 10), datetime(2024, 1, 20), repo_id=5)
    text = plan(found)
    assert re.search(r"PartitionFilters: \[.*event_date.*>= 2024-01-10.*event_date.*<= 2024-01-19", text)
    assert "EqualTo(repo_id,5)" in text
    dates = {str(r.event_date) for r in found.select("event_date").distinct().collect()}
    assert dates and min(dates) >= "2024-01-10" and max(dates) <= "2024-01-19"


def test_records_are_parsed_once(spark):
    log = fixtures.envelopes(fixtures.raw_messages(fixtures.redelivered(
        fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001")))))
    assert plan(good_rows(classify(project_envelope(log)))).count("from_json(") == 1


def test_ingest_metrics_count_before_the_shuffle(spark):
    df = spark.createDataFrame([("ok", "1")], "status string, id string")
    text = plan(metrics.ingest_metrics(df))
    assert text.count("partial_count") > 0 and "Expand" not in text


def test_stored_ids_are_read_alone_and_by_range(lake):
    batch = lake.fact.read_batch(1).persist()
    text = plan(dedup.first_unseen(batch, lake.keys.read(upto=0)))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "/keys/" in line)
    assert "GreaterThanOrEqual(event_id" in scan and "LessThanOrEqual(event_id" in scan
    assert "ReadSchema: struct<event_id:string>" in scan
    batch.unpersist()


def test_rows_of_a_batch_are_exchanged_once(spark, lake):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    batch = lake.fact.read_batch(1).persist()
    try:
        fresh = dedup.first_unseen(batch, lake.keys.read(upto=0))
        text = plan(fresh)
        assert "BroadcastHashJoin" not in text
        anti = text[text.index("LeftAnti"):]
        assert anti[: anti.index("InMemoryTableScan")].count("Exchange") == 1
        assert fresh.count() == batch.count()
        assert dedup.first_unseen(batch, lake.keys.read()).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        batch.unpersist()


def test_star_join_survives_without_broadcast(spark, lake):
    facts = lake.fact.read()
    repos, actors = dims.build_repos(facts), dims.build_actors(facts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = dims.star(facts.select("event_id", "repo_id", "actor_id"), repos, actors)
        assert "Broadcast" not in plan(joined)
        assert joined.count() == facts.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_in_any_plan(spark):
    from eventpulse.plans.catalog import QUERIES

    for name, query in QUERIES.items():
        if not name.startswith(("stream_", "incremental", "rollup_refresh")):
            assert "Python" not in plan(query(spark, "/root/testdata/sf0.001")), name
