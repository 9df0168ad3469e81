"""A durable table of the progress of streaming queries: one row per batch, written by a listener."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from rtml.streaming.statelog import Files

SCHEMA = """query_id string, run_id string, name string, batch_id long, at string, input_rows long,
 input_rows_per_second double, processed_rows_per_second double, duration_ms long,
 state_rows long, late_rows long, watermark string, sources array<string>"""


def progress_row(progress) -> dict:
    """Fields of one progress event that the table keeps."""
    return {
        "query_id": str(progress.id), "run_id": str(progress.runId), "name": progress.name,
        "batch_id": progress.batchId, "at": progress.timestamp,
        "input_rows": progress.numInputRows,
        "input_rows_per_second": progress.inputRowsPerSecond,
        "processed_rows_per_second": progress.processedRowsPerSecond,
        "duration_ms": progress.batchDuration,
        "state_rows": sum(s.numRowsTotal for s in progress.stateOperators),
        "late_rows": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        "watermark": progress.eventTime.get("watermark"),
        "sources": [s.description for s in progress.sources]}


def _finite(row: dict) -> dict:
    return {k: None if isinstance(v, float) and not abs(v) < float("inf") else v
            for k, v in row.items()}


class ProgressLog(StreamingQueryListener):
    """Writes every progress event of every query of the session under ``path``.

    Events are gathered ``batch`` at a time and at the end of a query, and published as one file
    each time, so a log of n events has n / batch files; at most ``batch`` events can be lost with
    the driver. Events without a batch (an idle query reports its last batch again) are written once
    in the table: readers keep one row per query and batch, the last one.
    """

    def __init__(self, spark: SparkSession, path: str, batch: int = 20):
        self.files, self.batch = Files(spark, path), batch
        self.waiting: list[str] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.waiting.append(json.dumps(_finite(progress_row(event.progress))))
            if len(self.waiting) >= self.batch:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            self.files.publish(f"events-{uuid.uuid4().hex}.json", "\n".join(self.waiting) + "\n")
            self.waiting = []


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch; a batch that was run again counts once, with its last report."""
    rows = spark.read.schema(SCHEMA).option("pathGlobFilter", "events-*.json").json(path)
    names = [f.name for f in rows.schema if f.name not in ("query_id", "batch_id")]
    last = F.max_by(F.struct(*names), F.struct("at", "run_id"))
    return rows.groupBy("query_id", "batch_id").agg(last.alias("r")) \
        .select("query_id", "batch_id", "r.*")


def progress_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per query: batches, rows, mean and longest batch, rows per second of work, late rows."""
    return progress_table(spark, path).groupBy("query_id").agg(
        F.max("name").alias("name"), F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"), F.avg("duration_ms").alias("mean_ms"),
        F.max("duration_ms").alias("longest_ms"),
        F.try_divide(F.sum("input_rows") * 1000.0, F.sum("duration_ms")).alias("rows_per_second"),
        F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", "batch_id").alias("state_rows"))
