"""Landed responses, log files, connector options and database readers and writers."""

import json
from datetime import datetime
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest

from eventpulse.operators.parse import classify, status_counts
from eventpulse.session import build_session, work_dir
from eventpulse.sinks import jdbc as jdbc_sink
from eventpulse.sinks.log import writer_options
from eventpulse.sources.jdbc import read_table
from eventpulse.sources.landed import read_json_lines, read_responses
from eventpulse.sources.log import log_options, read_log_files
from eventpulse.sources.scans import scan_range

EVENT = {"id": 1, "type": "t", "actor": {"id": 1}, "repo": {"id": 2}, "created_at": "2024-01-01T00:00:00Z"}


def folder(spark, name):
    import pathlib

    path = pathlib.Path(work_dir(spark, name).removeprefix("file:"))
    path.mkdir(parents=True)
    return path


def test_landed_responses(spark):
    path = folder(spark, "responses")
    (path / "0.json").write_text(json.dumps([EVENT, {"zeta": 1.50, "alpha": "é"}], indent=1, ensure_ascii=False))
    (path / "1.json").write_text("[]")
    (path / "2.json").write_text('{"message":"rate limited"}')
    (path / "3.json").write_text("[{broken")
    df = read_responses(spark, str(path))
    found = [r.json for r in df.collect()]
    assert json.dumps(EVENT, separators=(",", ":")) in found
    assert '{"zeta":1.5,"alpha":"é"}' in found
    assert "[{broken" in found
    counts = {r.status: r.record_count for r in status_counts(classify(df)).collect()}
    assert counts == {"ok": 1, "missing_required": 2, "malformed": 1}


def test_json_lines(spark):
    path = folder(spark, "lines")
    (path / "a.jsonl").write_text("\n".join([json.dumps(EVENT), "bad", json.dumps(EVENT)]))
    counts = {r.status: r.record_count for r in status_counts(classify(read_json_lines(spark, str(path)))).collect()}
    assert counts == {"ok": 2, "malformed": 1}


def test_log_options():
    assert log_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
    }
    more = log_options("h:1", "t", "earliest", 10, 4, failOnDataLoss="false")
    assert more["startingOffsets"] == "earliest"
    assert (more["maxOffsetsPerTrigger"], more["minPartitions"], more["failOnDataLoss"]) == ("10", "4", "false")


def test_writer_options():
    options = writer_options("h:1", "t")
    assert options["topic"] == "t"
    assert options["kafka.acks"] == "all"
    assert options["kafka.compression.type"] == "gzip"
    assert options["kafka.max.in.flight.requests.per.connection"] == "1"


def test_log_files_have_the_log_columns(spark):
    path = work_dir(spark, "archive")
    row = (b"1", b"{}", "t", 0, 5, datetime(2024, 1, 1))
    from eventpulse.schemas import ENVELOPE

    spark.createDataFrame([row], ENVELOPE).write.parquet(path)
    assert read_log_files(spark, path, streaming=False).collect()[0].offset == 5
    assert read_log_files(spark, path, max_bytes_per_trigger=1000).isStreaming


def test_table_scan_arguments():
    session = MagicMock()
    read_table(session, "url", "fact", {"user": "u"})
    session.read.jdbc.assert_called_with("url", "fact", properties={"user": "u"})
    read_table(session, "url", "fact", {}, "kafka_offset", (0, 99), 8)
    assert session.read.jdbc.call_args.kwargs["numPartitions"] == 8
    assert session.read.jdbc.call_args.kwargs["lowerBound"] == 0
    with pytest.raises(ValueError):
        read_table(session, "url", "fact", {}, "kafka_offset")


def test_append_new_is_safe_under_replay(spark):
    batch = spark.createDataFrame(
        [("a", 0, 2), ("a", 0, 1), ("b", 0, 3)], "event_id string, kafka_partition int, kafka_offset long"
    )
    stored = spark.createDataFrame([("b",)], "event_id string")
    added = jdbc_sink.append_new(batch, stored)
    assert [(r.event_id, r.kafka_offset) for r in added.collect()] == [("a", 1)]
    assert jdbc_sink.append_new(batch, added.select("event_id").union(stored)).count() == 0


def test_stored_keys_query():
    query = jdbc_sink.stored_keys_query("fact", "event_id", "t", datetime(2024, 1, 1), datetime(2024, 1, 2, 3))
    assert query == (
        "(SELECT event_id FROM fact WHERE t BETWEEN '2024-01-01 00:00:00' AND '2024-01-02 03:00:00') stored_keys"
    )


def test_overwrite_keeps_the_table():
    df = MagicMock()
    jdbc_sink.overwrite_table(df, "url", "types", {"user": "u"})
    df.write.mode.assert_called_with("overwrite")
    df.write.mode.return_value.option.assert_called_with("truncate", "true")


def test_scan_range_bounds(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 1, 12), datetime(2024, 1, 2), datetime(2024, 1, 3)]
    df = spark.createDataFrame([(t, t.date(), i) for i, t in enumerate(times)],
                               "event_created_at timestamp_ntz, event_date date, repo_id int")
    ids = [r.repo_id for r in scan_range(df, datetime(2024, 1, 1, 12), datetime(2024, 1, 3)).collect()]
    assert sorted(ids) == [1, 2]
    assert scan_range(df, repo_id=3).count() == 1
    assert scan_range(df, end=datetime(2024, 1, 2, 1)).count() == 3
    assert scan_range(df).count() == 4


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None),
    )
    with pytest.raises(ValueError):
        work_dir(cluster, "x")


def test_work_dir_is_in_the_named_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    assert work_dir(spark, "x") != work_dir(spark, "x")
    assert build_session is not None
