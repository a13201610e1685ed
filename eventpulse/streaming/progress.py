"""Counters of a query, while it runs and after it has ended."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventpulse.sinks.files import exists, write_text

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
    ]
)


def ingest_progress(query: StreamingQuery, name: str = "ingest") -> list[dict[str, object]]:
    """Batch id, input rows and the observed counters of the query's recent batches."""
    rows = []
    for progress in query.recentProgress:
        counters = progress.observedMetrics.get(name)
        rows.append(
            {"batch_id": progress.batchId, "input_rows": progress.numInputRows}
            | (counters.asDict() if counters else {})
        )
    return rows


class ProgressLog(StreamingQueryListener):
    """Every executed batch of the session's streams, kept under a path of the shared file system.

    A batch is one small file named by the stream's id, which its checkpoint keeps, and
    its batch id. So a repeated batch replaces its entry, and the log of a stream goes on
    over restarts and in other sessions. Register it with ``spark.streams.addListener()``
    before the stream starts. Spark reports progress a little after a batch ends;
    ``wait()`` returns once all of a finished query is there.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "ingest"):
        self.spark, self.path, self.name = spark, path, name
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if "addBatch" not in progress.durationMs:  # nothing was executed
            return
        counters = progress.observedMetrics.get(self.name)
        row = {
            "query_id": str(progress.id),
            "run_id": str(progress.runId),
            "batch_id": progress.batchId,
            "finished_at": progress.timestamp,
            "input_rows": progress.numInputRows,
            "duration_ms": progress.batchDuration,
            "counters": counters.asDict() if counters else {},
        }
        write_text(self.spark, f"{self.path}/{progress.id}/batch-{progress.batchId}.json", json.dumps(row) + "\n")

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Whether the end of the query's run, and all progress before it, has been reported in time."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)

    def read(self, query_id: str | None = None) -> DataFrame:
        """One row for each batch of all streams, or of one."""
        path = self.path if query_id is None else f"{self.path}/{query_id}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").json(path)
