"""Helpers shared by the operators: shipping code, shared tables, checked broadcasts, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtml.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Rows that a hinted broadcast may have at most; each holds a few fixed-width values.
BROADCAST_ROWS = 1_000_000


def prepare(spark: SparkSession, batch_rows: int = 512) -> None:
    """Make worker processes able to import this package and keep Arrow batches of texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def give_back() -> None:
    """Return freed memory of this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def giving_back(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; what it held goes back to the system at the end of the task.

    A worker process serves many tasks. Freed memory otherwise stays with its allocators, and the
    stages of a pipeline add up.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to a new folder of the shared working folder and read it back; cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a *stored* table of fixed-width columns after counting its rows.

    A longer table comes back without hint and is joined by a shuffle.
    """
    return F.broadcast(table) if table.count() <= rows else table


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row by its id and text."""
    return [F.xxhash64(id_col).alias("_k1"), F.xxhash64(text_col).alias("_k2")]


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is in ``keys``; all columns stay as they are.

    Up to ``BROADCAST_ROWS`` keys (two longs each) are broadcast, more are joined by a shuffle.
    """
    keys = broadcast_checked(stored(keys.distinct(), "keys"))
    k1, k2 = row_key(id_col, text_col)
    return docs.join(keys, (k1 == keys["_k1"]) & (k2 == keys["_k2"]), "left_anti")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (columns ``a``, ``b``, long) as (``node``, ``component``).

    Alternating large-star and small-star rounds: every round is two aggregations and two joins,
    written to the shared folder, until the edges no longer change; the number of rounds follows
    the logarithm of the longest path. ``component`` is the smallest node; nodes without an edge
    are not listed. Self loops and repeated edges are ignored. A star's centre may hold any number
    of edges: its join is one that adaptive execution splits.
    """
    now = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", "m")).distinct()
        now = stored(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
