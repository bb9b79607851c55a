"""Progress of streams as stored rows: what every batch read, where its watermark stood and how many
rows came too late for it."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources import storage

SCHEMA = ("query_id string, run_id string, name string, batch_id long, noted_at timestamp, input_rows long, "
          "input_rows_per_second double, processed_rows_per_second double, event_time_mark timestamp, "
          "rows_dropped_by_watermark long, state_rows long")
_TIMES = ("noted_at", "event_time_mark")


def progress_row(progress: dict) -> tuple:
    """One row of SCHEMA from a progress event; times as ISO text."""
    states = progress.get("stateOperators") or []
    return (progress["id"], progress["runId"], progress.get("name"), progress["batchId"], progress["timestamp"],
            progress.get("numInputRows") or 0, progress.get("inputRowsPerSecond"), progress.get("processedRowsPerSecond"),
            (progress.get("eventTime") or {}).get("watermark"),
            sum(s.get("numRowsDroppedByWatermark") or 0 for s in states), sum(s.get("numRowsTotal") or 0 for s in states))


class ProgressLog(StreamingQueryListener):
    """Stores the progress of all queries of a session, every `every` events and when a query ends.

    A run of a query is one folder of rows; rows are appended, never rewritten.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.lock, self.ended = threading.Lock(), {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.held.append(progress_row(json.loads(event.progress.json)))
            full = len(self.held) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last event of a query that ended has been stored; events come after the end."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no event of the end of query {query.runId}")

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            text = SCHEMA
            for name in _TIMES:
                text = text.replace(f"{name} timestamp", f"{name} string")
            typed = self.spark.createDataFrame(rows, text).withColumns({n: F.col(n).cast("timestamp") for n in _TIMES})
            storage.append(typed.coalesce(1), self.path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.createDataFrame([], SCHEMA).schema
    return storage.read(spark, path, schema) if storage.exists(spark, path) else spark.createDataFrame([], schema)


def by_query(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows read, late rows dropped, the highest mark and the last event."""
    return progress.groupBy("query_id").agg(
        F.count_distinct("run_id", "batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("rows_dropped_by_watermark").alias("dropped_rows"), F.max("event_time_mark").alias("event_time_mark"),
        F.max("noted_at").alias("last_event"))
