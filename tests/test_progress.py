"""Progress that outlives its query."""

from pyspark.sql import functions as F

from eventpulse.plans import fixtures
from eventpulse.plans.lake import Lake
from eventpulse.session import work_dir
from eventpulse.streaming.progress import PROGRESS, ProgressLog
from tests.test_streaming import few_state_partitions, ingest, land  # noqa: F401


def test_progress_of_a_restarted_stream(spark):
    root = work_dir(spark, "progress")
    lake, log = Lake(spark, f"{root}/lake"), ProgressLog(spark, f"{root}/progress")
    assert log.read().count() == 0 and log.read().schema == PROGRESS
    messages = fixtures.raw_messages(fixtures.redelivered(fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001"))))
    spark.streams.addListener(log)
    try:
        runs = []
        for low in (0, 600):
            for third in (low, low + 200, low + 400):
                land(messages.where(F.col("n").between(third, third + 199)), f"{root}/log")
            query = ingest(spark, root, lake)
            assert log.wait(query)
            runs.append(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    rows = {r.batch_id: r for r in ProgressLog(spark, f"{root}/progress").read(str(query.id)).collect()}
    assert sorted(rows) == lake.fact.batches() == list(range(6))
    assert [rows[n].run_id for n in range(6)] == [runs[0]] * 3 + [runs[1]] * 3
    for n, row in rows.items():
        stored = lake.metrics.read_batch(n).first()
        assert row.counters["fetched"] == row.input_rows == stored.fetched and row.duration_ms > 0
        # the fact table counts a bad timestamp as invalid, the counters as passed
        assert row.counters["invalid"] + row.counters["errors"] + row.counters["passed"] == stored.fetched
        assert stored.published + stored.duplicates <= row.counters["passed"]
    assert log.read().count() == 6 and log.read("none").count() == 0


def test_a_repeated_batch_replaces_its_entry(spark):
    log = ProgressLog(spark, work_dir(spark, "progress-repeat"))

    class Event:
        class progress:
            id, runId, batchId, timestamp, numInputRows, batchDuration = "q", "r", 3, "t", 5, 7
            durationMs, observedMetrics = {"addBatch": 1}, {}

    for n in (5, 6):
        Event.progress.numInputRows = n
        log.onQueryProgress(Event)
    Event.progress.batchId, Event.progress.durationMs = 4, {"triggerExecution": 1}
    log.onQueryProgress(Event)
    assert [(r.batch_id, r.input_rows, r.counters) for r in log.read().collect()] == [(3, 6, {})]
