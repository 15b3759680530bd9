"""What a running stream did at each trigger, as a table, and a way to end it from outside."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from feedmill.sources.scratch import exists, touch

PROGRESS_SCHEMA = "query string, run string, batch bigint, at string, rows bigint, milliseconds bigint, idle boolean"
# Triggers that wait in memory before they are written.
WRITE_AFTER = 100


class ProgressLog(StreamingQueryListener):
    """Appends one row per trigger to a table: batch, rows and duration, or that there was nothing to do.

    Rows wait in memory until ``write_after`` of them have come together or a query ends, so
    a long stream writes few files. Idle triggers come as often as Spark reports them, by default
    once in ten seconds. Add it by ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, write_after: int = WRITE_AFTER):
        self.spark, self.path, self.write_after = spark, path, write_after
        self.idle = threading.Event()
        self.ended = threading.Event()
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        done = event.progress
        spent = done.durationMs.get("triggerExecution")
        self._add((str(done.id), str(done.runId), done.batchId, done.timestamp, done.numInputRows, spent, False))

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        self._add((str(event.id), str(event.runId), None, event.timestamp, 0, None, True))
        self.idle.set()

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.write()
        self.ended.set()

    def _add(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.write_after
        if full:
            self.write()

    def write(self) -> None:
        """Append the rows that wait."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """All triggers written so far."""
    if not exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)


def request_stop(spark: SparkSession, marker: str) -> None:
    """Ask the job that watches this marker to end its stream."""
    touch(spark, marker)


def run_until_marked(query: StreamingQuery, spark: SparkSession, marker: str, every: float = 5) -> bool:
    """Wait for the query's end, or stop it once the marker is there; returns whether the marker ended it.

    A batch that is cut off is written again by the next start. The marker stays: whoever set it removes it.
    """
    while not query.awaitTermination(every):
        if exists(spark, marker):
            query.stop()
            return True
    return False
