"""Row and time frames never subtract: huge values and NaN act on their own frames only."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rtml.operators.rolling import rolling_means, time_rolling_means

START = dt.datetime(2024, 1, 1)


def values(n):
    x = [float(i % 7) for i in range(n)]
    x[20], x[35], x[50], x[51] = 1e17, float("nan"), None, -1e17
    return x


def same(a, b):
    return a == b or (a is not None and b is not None and (
        math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12)))


def mean(frame):
    got = [v for v in frame if v is not None]
    return math.fsum(got) / len(got) if got and not any(map(math.isnan, got)) else \
        (float("nan") if got else None)


@pytest.mark.parametrize("forced", [False, True])
def test_time_frames(spark, forced):
    if forced:
        spark.conf.set("rtml.chunk.minBytes", "0")
    try:
        x = values(90)
        at = [START + dt.timedelta(seconds=(i // 2) * 7) for i in range(90)]  # pairs of equal times
        df = spark.createDataFrame(list(zip(range(90), at, ["a", "b", "a"] * 30, x)),
                                   "id long, ts timestamp, k string, x double").repartition(3)
        found = time_rolling_means(df, ["k"], "ts", {"m": F.col("x")}, seconds=60)
        rows = {r.id: r for r in found.collect()}
        assert found.columns == ["id", "ts", "k", "x", "rows_in_frame", "m"] and len(rows) == 90
        for i in range(90):
            frame = [x[j] for j in range(90) if j % 3 % 2 == i % 3 % 2 and
                     at[i] - dt.timedelta(seconds=60) <= at[j] <= at[i]]
            assert rows[i].rows_in_frame == len(frame)
            assert same(rows[i].m, mean(frame)), i
    finally:
        spark.conf.unset("rtml.chunk.minBytes")


def test_row_frames(spark):
    x = values(90)
    df = spark.createDataFrame(list(enumerate(x)), "id long, x double")
    rows = {r.id: r.m for r in rolling_means(df, [], "id", {"m": F.col("x")}, 8, 16).collect()}
    for i in range(90):
        assert same(rows[i], mean(x[max(0, i - 7):i + 1])), i


def test_row_frames_are_linear(spark):
    df = spark.range(10).select("id", F.col("id").cast("double").alias("x"))
    plan = rolling_means(df, [], "id", {"m": F.col("x")}, 4, 8)._jdf.queryExecution().toString()
    assert "unboundedfollowing" not in plan.lower()
