"""Bagged forest: weights, single replacements, restarts and odd rows."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from rtml.streaming.bagging import BaggedForest, bag_weight, poisson_cdf


def batch(spark, b, flipped, n=600):
    """The label follows ``a`` (turned round if ``flipped``) and, in a fifth of the rows, ``c``."""
    rows = spark.range(b * n, b * n + n).select(
        F.col("id"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000).alias("c"))
    side = F.col("a") < 0.5 if flipped else F.col("a") >= 0.5
    return rows.withColumn("y", side.cast("int"))


def run(step, spark, first, last, change=4):
    for b in range(first, last):
        step(batch(spark, b, b >= change), b)


def forest(spark, path):
    return BaggedForest(spark, str(path), ["a", "c"], "y", "id", trees=4, subset=1, window=6,
                        depth=3, seed=7)


def test_weights_are_poisson(spark):
    keys = [str(i) for i in range(400)]
    cdf = poisson_cdf()
    want = {k: sum(p <= int(hashlib.md5(f"{k}:3".encode()).hexdigest()[:8], 16) / 2 ** 32
                   for p in cdf) for k in keys}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert dict(df.select("k", bag_weight("k", 3)).collect()) == want
    mean = sum(want.values()) / 400
    assert abs(mean - 6) < 0.5
    assert abs(sum((w - mean) ** 2 for w in want.values()) / 400 - 6) < 1.5
    assert math.isclose(cdf[0], math.exp(-6)) and cdf[-1] <= 1


def test_only_drifting_trees_are_replaced(spark, tmp_path):
    step = forest(spark, tmp_path / "one")
    run(step, spark, 0, 7)
    on_a = {t for t, names in enumerate(step.subsets) if names == ["a"]}
    assert on_a and len(on_a) < 4
    log = {r.batch_id: r for r in step.metrics.all().collect()}
    replaced = {t for r in log.values() for t in r.replaced}
    assert replaced == on_a
    assert all(not r.replaced for b, r in log.items() if b < 4)
    share = {b: r.errors / r.rows for b, r in log.items() if r.rows}
    assert share[3] < 0.2 and share[4] > 0.6 and share[6] < 0.2
    names = {f"tree-{r.tree}-{r.grown_at}" for r in step.state.all().collect()}
    assert {p.name for p in (tmp_path / "one" / "models").iterdir()} == names

    other = forest(spark, tmp_path / "two")         # stopped, restarted, and one batch run twice
    run(other, spark, 0, 5)
    other = forest(spark, tmp_path / "two")
    run(other, spark, 4, 7)
    state = [s.state.version(6).orderBy("tree").collect() for s in (step, other)]
    assert state[0] == state[1]
    new = batch(spark, 9, True)
    assert step.score(new).orderBy("id").collect() == other.score(new).orderBy("id").collect()


def test_odd_rows(spark, tmp_path):
    step = forest(spark, tmp_path)
    shape = "id long, a double, c double, y int, _y string"
    with pytest.raises(ValueError):
        step.score(spark.createDataFrame([], shape))
    step(spark.createDataFrame([], shape), 0)
    step(spark.createDataFrame([(1, None, 0.1, 1, "x"), (None, 0.2, None, 0, "x"),
                                (2, 0.3, 0.4, None, "x"), (3, 0.9, 0.9, 1, None),
                                (3, 0.1, 0.1, 0, None)], shape), 1)
    step(spark.createDataFrame([(7, None, None, 1, "x")], shape), 2)
    out = step.score(spark.createDataFrame([(5, 0.9, 0.9, None, "kept"), (6, None, 1.0, 1, "")],
                                           shape))
    assert out.columns == ["id", "a", "c", "y", "_y", "prediction"]
    assert [r.id for r in out.collect()] == [5]


def test_digest_is_taken_once_per_weight(spark):
    plan = spark.range(1).select(bag_weight("id", 0)) \
        ._jdf.queryExecution().analyzed().toString()
    assert "md5" in plan and "md5" not in plan.partition("lambdafunction")[2].partition("AS ")[0]


def test_slices_of_many_files_stay_one_batch_each(spark, tmp_path, monkeypatch):
    from rtml.suite import streams
    from rtml.suite.base import Tables
    monkeypatch.setattr(streams, "_FILE_ROWS", 50)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: str(tmp_path / label))
    rows, seen = spark.range(1000).withColumn("v", F.col("id") % 7), {}
    for stream in streams._in_slices(Tables(spark, str(tmp_path)), rows, "id"):
        stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True) \
            .foreachBatch(lambda b, i: seen.update({i: b.agg(
                F.count("id"), F.min("id"), F.max("id")).first()})).start().awaitTermination()
    assert len(seen) == 4 and sum(r[0] for r in seen.values()) == 1000
    assert all(seen[i][2] < seen[i + 1][1] for i in range(3))
    assert len(list((tmp_path / "slices").glob("part-*.parquet"))) == 4 * (min(
        r[0] for r in seen.values()) // 50)
