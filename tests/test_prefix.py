"""Chunked order primitives equal their single-window definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from rtml.operators.rolling import rolling_means, time_rolling_means
from rtml.operators.sessions import session_ids
from rtml.plans import prefix as P


def frame(spark, seed, rows=400, hot=0.5):
    """Half of the rows share one key; some keys are null; times repeat."""
    r = random.Random(seed)
    data = [(i, "hot" if r.random() < hot else r.choice(["a", "b", None]),
             r.randint(0, rows * 3), r.choice([None, r.random() * 10])) for i in range(rows)]
    return spark.createDataFrame(data, "id long, k string, t long, x double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_running_totals(spark, seed):
    df = frame(spark, seed)
    cut = P.with_chunk(df, "id", chunks=7)
    assert cut.select(P.CHUNK).distinct().count() == 7
    got = P.running_totals(cut, ["k"], ["id"], {"s": F.col("x"), "n": F.lit(1)})
    w = Window.partitionBy("k").orderBy("id")
    want = df.select("id", F.sum("x").over(w).alias("s2"), F.row_number().over(w).alias("n2"))
    bad = got.join(want, "id").where("n <> n2 or not (round(s, 9) <=> round(s2, 9))")
    assert got.count() == df.count() and bad.count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_running_totals_peers_and_descending(spark, seed):
    df = frame(spark, seed).withColumn("t", F.col("t") % 50)
    got = P.running_totals(P.with_chunk(df, "t", chunks=6), ["k"], [F.col("t").desc()],
                           {"n": F.lit(1)}, descending=True, peers=True)
    w = Window.partitionBy("k").orderBy(F.col("t").desc())
    want = df.select("id", F.count(F.lit(1)).over(w).alias("n2"))
    assert got.join(want, "id").where("n <> n2").count() == 0


def test_previous_value(spark):
    df = frame(spark, 6)
    got = P.previous_value(P.with_chunk(df, "id", chunks=9), ["k"], "id", ["id", "x"])
    w = Window.partitionBy("k").orderBy("id")
    want = df.select("id", F.lag("id").over(w).alias("i2"), F.lag("x").over(w).alias("x2"))
    assert got.join(want, "id").where("not (prev_id <=> i2) or not (prev_x <=> x2)").count() == 0


def test_only_hot_keys_are_cut(spark, chunked):
    df = frame(spark, 7)
    cut = P.with_hot_chunk(df, ["k"], "id", hot_rows=120, chunks=5)
    chunks = {r.k: r.n for r in cut.groupBy("k").agg(F.count_distinct(P.CHUNK).alias("n")).collect()}
    assert chunks["hot"] == 5 and all(n == 1 for k, n in chunks.items() if k != "hot")
    assert cut.count() == df.count()


def test_equal_values_share_a_chunk(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("v"))
    cut = P.with_chunk(df, "v", chunks=8)
    assert cut.groupBy("v").agg(F.count_distinct(P.CHUNK).alias("n")).where("n > 1").count() == 0


def test_overlap_copies_each_row_once_as_own(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "rn")
    cut = P.overlapped(df, "rn", 20, 7)
    assert cut.where("_own").count() == 100
    assert cut.where("not _own").groupBy("_block").count().select("count").distinct().first()[0] == 7


def test_ordered_index_over_text(spark):
    words = [f"w{i:04d}" for i in random.Random(8).sample(range(10000), 500)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = {r.w: r.idx for r in P.ordered_index(df, [F.col("w").asc_nulls_last()]).collect()}
    assert got == {w: i for i, w in enumerate([*sorted(words), None])}


@pytest.mark.parametrize("rows", [1, 2, 10, 999])
def test_exact_quantiles_match_numpy(spark, rows):
    values = [random.Random(rows).gauss(0, 5) for _ in range(rows)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    qs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.93, "e": 1.0}
    got = P.exact_quantiles(df, "x", qs).first()
    for name, q in qs.items():
        assert got[name] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_exact_quantiles_inside_brackets(spark, monkeypatch):
    """Above the row limit only the bracketed values are ordered."""
    monkeypatch.setattr(P, "_BRACKET_ROWS", 1000)
    df = spark.range(20000).select((F.pmod(F.hash("id"), F.lit(7919)) / 7.0).alias("x"))
    values = [r.x for r in df.collect()]
    qs = {"a": 0.001, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.999}
    got = P.exact_quantiles(df, "x", qs).first()
    for name, q in qs.items():
        assert got[name] == pytest.approx(np.quantile(values, q), abs=1e-9)


def test_grouped_quantiles(spark):
    df = frame(spark, 9)
    got = {r.k: r.m for r in P.grouped_quantiles(df, "x", {"m": 0.5}, ["k"]).collect()}
    for key in ("hot", "a", None):
        values = [r.x for r in df.where(F.col("k").eqNullSafe(F.lit(key))).collect()
                  if r.x is not None]
        assert got[key] == pytest.approx(np.quantile(values, 0.5))


def test_rolling_over_block_borders(spark):
    df = spark.range(500).select("id", (F.col("id") % 17).cast("double").alias("x"))
    got = rolling_means(df, [], "id", {"m": F.col("x")}, rows=10, rows_per_block=30)
    w = Window.orderBy("id").rowsBetween(-9, 0)
    want = df.select("id", F.avg("x").over(w).alias("m2"))
    assert got.join(want, "id").where("abs(m - m2) > 1e-9").count() == 0 and got.count() == 500


@pytest.mark.parametrize("bytes_limit", ["0", str(32 << 20)])
def test_time_rolling(spark, bytes_limit):
    spark.conf.set("rtml.chunk.minBytes", bytes_limit)
    r = random.Random(10)
    data = [(i, r.randint(0, 4000), float(r.randint(0, 9))) for i in range(600)]
    df = spark.createDataFrame(data, "id long, s long, x double") \
        .withColumn("ts", F.timestamp_seconds("s"))
    got = time_rolling_means(df, [], "ts", {"m": F.col("x")}, seconds=60)
    spark.conf.unset("rtml.chunk.minBytes")
    w = Window.orderBy("s").rangeBetween(-60, 0)
    want = df.select("id", F.avg("x").over(w).alias("m2"), F.count(F.lit(1)).over(w).alias("n2"))
    bad = got.join(want, "id").where("abs(m - m2) > 1e-9 or rows_in_frame <> n2")
    assert got.count() == 600 and bad.count() == 0


def test_sessions_same_whole_and_in_chunks(spark, chunked):
    df = frame(spark, 11).select("id", "k", F.timestamp_seconds("t").alias("ts"))
    a = session_ids(df, "k", "ts", 20, hot_rows=10**9).select("id", "session_no")
    b = session_ids(df, "k", "ts", 20, hot_rows=None).select("id", "session_no")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() == df.count()
