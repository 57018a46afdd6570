"""Progress of streams as a table: rates, durations, watermark, late rows."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("state_rows", T.LongType()),
    ]
)


def _row(progress: dict) -> tuple:
    operators = progress.get("stateOperators") or []
    return (
        progress.get("name"),
        progress["batchId"],
        progress["timestamp"],
        progress.get("numInputRows"),
        progress.get("inputRowsPerSecond"),
        progress.get("processedRowsPerSecond"),
        (progress.get("durationMs") or {}).get("triggerExecution"),
        (progress.get("eventTime") or {}).get("watermark"),
        sum(op.get("numRowsDroppedByWatermark") or 0 for op in operators),
        sum(op.get("numRowsTotal") or 0 for op in operators),
    )


def progress_table(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The kept progress of the given queries (Spark keeps the last 100 updates of each)."""
    rows = [_row(json.loads(p.json)) for q in queries for p in q.recentProgress]
    return spark.createDataFrame(rows, PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all streams of a session to a table of JSON lines, ``every`` updates at a time
    and when the last stream ends.

    Add it with ``spark.streams.addListener``. No more than ``every`` updates are kept in memory.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self._spark, self._path, self._every = spark, path, every
        self._running, self._ended = set(), threading.Condition()
        self._rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        with self._ended:
            self._running.add(event.runId)

    def onQueryProgress(self, event) -> None:
        with self._ended:
            self._rows.append(_row(json.loads(event.progress.json)))
            if len(self._rows) >= self._every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._ended:
            self._running.discard(event.runId)
            if not self._running:
                self._flush()
            self._ended.notify_all()

    def _flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            table = self._spark.createDataFrame(rows, PROGRESS).coalesce(1)
            table.write.mode("append").json(self._path)

    def wait(self, seconds: float = 60.0) -> bool:
        """Until the updates of all streams that have ended are in the table; they arrive with a delay."""
        with self._ended:
            return self._ended.wait_for(lambda: not self._running, seconds)

    def table(self) -> DataFrame:
        with self._ended:
            self._flush()
        return self._spark.read.schema(PROGRESS).json(self._path)
