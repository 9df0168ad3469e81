"""Event-time windows, streaming counters and query progress."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(df: DataFrame, ts: str, by: list[str], window: str = "5 minutes",
                    slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts per event-time window; rows later than ``delay`` are dropped in append mode."""
    timed = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    w = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    return timed.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def session_counts(df: DataFrame, user: str, ts: str, gap: str = "15 minutes",
                   delay: str = "10 minutes") -> DataFrame:
    timed = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return timed.groupBy(F.session_window("_ts", gap).alias("w"), user) \
        .agg(F.count(F.lit(1)).alias("events")).select(
            user, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "events")


def append_table(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_table(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write the whole result of a streaming aggregation per batch, one folder each.

    A folder is replaced as a whole when its batch is run again, so retries change nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    writer = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint) \
        .foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("version")).scalar()
    return versions.where(F.col("version") == newest).drop("version")


def progress_table(query: StreamingQuery) -> DataFrame:
    """Recent progress of a query: rates, latency, state size, watermark, late rows."""
    rows = []
    for p in query.recentProgress:
        doc = p if isinstance(p, dict) else json.loads(p.json)
        state = doc.get("stateOperators") or []
        seen, done = doc.get("inputRowsPerSecond"), doc.get("processedRowsPerSecond")
        rows.append((doc["batchId"], doc.get("numInputRows", 0), seen, done,
                     done / seen if seen and done else None,
                     doc.get("durationMs", {}).get("triggerExecution"),
                     sum(s.get("numRowsTotal", 0) for s in state),
                     sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
                     (doc.get("eventTime") or {}).get("watermark")))
    return SparkSession.active().createDataFrame(
        rows, "batch_id long, input_rows long, input_rate double, processing_rate double, "
        "rate_ratio double, latency_ms long, state_rows long, late_rows long, watermark string")
