"""Density clusters, components and class balancing over batches."""

import numpy as np
import pytest

from rtml.operators.graph import connected
from rtml.streaming.balance import BalancedStream
from rtml.streaming.density import DensityClusters


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)],
                                 "id long, x array<double>")


def blobs(draw, centers, n, spread):
    return np.concatenate([draw.normal(c, spread, (n, len(c))) for c in centers])


def test_touching_blobs_merge_and_apart_ones_do_not(spark, tmp_path):
    draw = np.random.default_rng(0)
    step = DensityClusters(spark, str(tmp_path / "s"), "x", radius=1.0, dims=2, intersection=0.2)
    for n in range(3):
        step(frame(spark, blobs(draw, [(0, 0), (2, 0), (12, 0)], 150, 0.6)), n)
    probe = frame(spark, np.array([(0, 0), (2, 0), (12, 0), (6.5, 0), (50, 50)]))
    found = {r.id: r.cluster for r in step.assign(probe, 2).collect()}
    assert found[0] == found[1] and found[0] != found[2] and found[2] is not None
    assert found[4] is None
    centers = step.clusters(2).collect()
    assert len({r.mc for r in centers}) == len(centers) < 100
    assert step.history.version(2).first().rows == 450


def test_a_share_of_one_half_on_a_line(spark, tmp_path):
    step = DensityClusters(spark, str(tmp_path / "s"), "x", radius=1.0, dims=1)
    line = np.concatenate([np.linspace(0, 5, 400), np.linspace(9, 11, 160)])[:, None]
    for n in range(2):
        step(frame(spark, line), n)
    found = [(r.center[0], r.cluster) for r in step.clusters(1).collect()]
    assert not {c for x, c in found if x < 7} & {c for x, c in found if x > 7}
    assert len({c for x, c in found}) < len(found)


def test_every_row_is_near_a_center(spark, tmp_path):
    draw = np.random.default_rng(1)
    step = DensityClusters(spark, str(tmp_path / "s"), "x", radius=0.7, dims=3)
    x = draw.uniform(-3, 3, (400, 3))
    rows = frame(spark, x).selectExpr("id AS _row", "x AS _x")
    old = spark.createDataFrame([(1, [0.0, 0.0, 0.0], 1.0)], "mc long, center array<double>, weight double")
    fresh = step._new_centers(rows, old, 2)
    centers = np.array([[0, 0, 0], *[r.center for r in fresh.collect()]])
    gap = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (gap.min(axis=1) <= 0.49 + 1e-12).all()
    apart = ((centers[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (apart[~np.eye(len(centers), dtype=bool)] > 0.49 - 1e-12).all()
    near = {(r._row, r.mc) for r in step.near(rows, old.union(fresh)).collect()}
    ids = [1, *[r.mc for r in fresh.collect()]]
    assert near == {(i, ids[j]) for i, j in zip(*np.where(gap <= 0.49))}


def test_many_dimensions_make_few_micro_clusters(spark, tmp_path):
    draw = np.random.default_rng(2)
    step = DensityClusters(spark, str(tmp_path / "s"), "x", radius=2.0, dims=64)
    centers = draw.normal(0, 5, (4, 64))
    step(frame(spark, blobs(draw, centers, 200, 0.1)), 0)
    found = step.clusters(0).collect()
    assert len(found) < 40 and len({r.cluster for r in found}) == 4


def test_old_clusters_fade_and_repeats_change_nothing(spark, tmp_path):
    draw = np.random.default_rng(3)
    step = DensityClusters(spark, str(tmp_path / "s"), "x", radius=1.0, dims=2, fading=1.0,
                           cleanup=1, min_weight=5)
    step(frame(spark, blobs(draw, [(0, 0)], 50, 0.2)), 0)
    for n in range(1, 6):
        step(frame(spark, blobs(np.random.default_rng(n), [(9, 9)], 50, 0.2)), n)
    before = sorted(map(tuple, step.clusters(5).select("mc", "weight", "cluster").collect()))
    again = DensityClusters(spark, str(tmp_path / "s"), "x", radius=1.0, dims=2, fading=1.0,
                            cleanup=1, min_weight=5)
    again(frame(spark, blobs(np.random.default_rng(5), [(9, 9)], 50, 0.2)), 5)
    after = again.clusters(5)
    assert all(abs(r.center[0] - 9) < 2 for r in after.collect())
    assert sum(r.weight for r in after.collect()) == pytest.approx(sum(w for _, w, _ in before))
    bad = spark.createDataFrame([(1, None), (2, [1.0]), (3, [float("nan"), 0.0])],
                                "id long, x array<double>")
    again(bad, 6)
    assert again.history.version(6).first().rows == 0


def test_connected(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7), (102, 999)]
    nodes = spark.createDataFrame([(i,) for i in [*range(1, 61), 100, 101, 102]], "id long")
    found = {r.node: r.component for r in
             connected(nodes, spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 102}
    assert connected(nodes.where("false"), spark.createDataFrame(links, "a long, b long")).count() == 0


def fraud(spark, start, n, every):
    return spark.createDataFrame([(i, "fraud" if i % every == 0 else "ok")
                                  for i in range(start, start + n)] + [(10 ** 6 + start, None)],
                                 "id long, y string")


def test_classes_are_balanced_in_four_batches(spark, tmp_path, chunked):
    batches = [fraud(spark, i * 400, 400, e) for i, e in enumerate((20, 5, 50, 10))]
    step = BalancedStream(spark, str(tmp_path / "a"), "y", "id")
    for n, b in enumerate(batches):
        step(b, n)
    assert {r.label: r.share for r in step.report(3).collect()} == {"fraud": 0.5, "ok": 0.5}
    rows = spark.read.parquet(step.accepted_path)
    count = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    assert count == {"fraud": 20 + 80 + 8 + 40, "ok": 148}
    other = BalancedStream(spark, str(tmp_path / "b"), "y", "id")
    for n, b in enumerate(batches):
        if n == 2:
            other(b.limit(10), n)  # a batch that fails and is run again, by a new process
            other = BalancedStream(spark, str(tmp_path / "b"), "y", "id")
        other(b.repartition(3), n)
    assert sorted(r.id for r in spark.read.parquet(other.accepted_path).collect()) == \
        sorted(r.id for r in rows.collect())


def test_wanted_shares(spark, tmp_path):
    step = BalancedStream(spark, str(tmp_path / "a"), "y", "id", {"ok": 0.75, "fraud": 0.25})
    for n in range(3):
        step(fraud(spark, n * 100, 100, 10), n)
    assert {r.label: r.accepted for r in step.report(2).collect()} == {"fraud": 30, "ok": 90}
    step(fraud(spark, 0, 0, 1), 3)
    assert {r.label: r.accepted for r in step.report(3).collect()} == {"fraud": 30, "ok": 90}


def test_blocks_find_the_pairs_of_a_sum_place_by_place(spark, tmp_path, monkeypatch):
    """Every pair within the radius, with the very sum, however rows and centers are cut into blocks."""
    import numpy as np
    from rtml.streaming import density
    monkeypatch.setattr(density, "BLOCK", 40)
    draw = np.random.default_rng(3)
    x, c = draw.integers(-2, 3, (150, 5)) / 4, draw.integers(-2, 3, (90, 5)) / 4  # many at the radius itself
    x[7], x[9, 2] = x[7] * 1e9, np.nan
    step = density.DensityClusters(spark, str(tmp_path), "v", radius=0.75, dims=5)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "_row long, _x array<double>")
    centers = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "mc long, center array<double>")
    want = {}
    for i, a in enumerate(x):
        for j, b in enumerate(c):
            d2 = 0.0
            for p, q in zip(a.tolist(), b.tolist()):
                d2 += (p - q) * (p - q)
            if d2 <= 0.75 ** 2:
                want[i, j] = d2
    found = step.near(rows, centers).collect()
    assert {(r._row, r.mc): r.d2 for r in found} == want and len(found) == len(want) > 1000
    assert all(r._x == x[r._row].tolist() for r in found)
    assert step.near(rows, centers.where("mc < 0")).count() == 0


def test_handfuls_choose_the_centers_of_one_long_row(spark, tmp_path, monkeypatch):
    """Few handfuls, and centers as if rows came one by one in the order of their hash."""
    from pyspark.sql import functions as F
    from rtml.streaming import density
    monkeypatch.setattr(density, "LEADERS", 20)
    monkeypatch.setattr(density, "BLOCK", 60)
    draw = np.random.default_rng(8)
    x = np.concatenate([draw.uniform(-4, 4, (500, 2)), draw.normal(1, 0.1, (200, 2))])
    x[300:320] = x[280:300]  # rows that come twice
    step = density.DensityClusters(spark, str(tmp_path), "x", radius=0.4, dims=2)
    rows = frame(spark, x).selectExpr("id AS _row", "x AS _x").persist()
    old = spark.createDataFrame([(4, [0.0, 0.0], 1.0)], "mc long, center array<double>, weight double")
    order = [r._row for r in rows.select("_row").orderBy(F.xxhash64("_row")).collect()]
    want, at = [], np.array([[0.0, 0.0]])
    for i in order:
        if ((at - x[i]) ** 2).sum(axis=1).min() > 0.4 ** 2:
            at = np.vstack([at, x[i]])
            want.append((5 + len(want), x[i].tolist()))
    calls = []
    near = step.near
    monkeypatch.setattr(step, "near", lambda a, b: (calls.append(1), near(a, b))[1])
    found = sorted((r.mc, r.center) for r in step._new_centers(rows, old, 5).collect())
    assert found == want and len(want) > 60
    assert len(calls) <= 5  # uncovered rows in handfuls of 20 took one call each


def test_first_apart_of_close_pairs():
    from rtml.streaming.density import _first_apart
    order = np.array([7, 3, 9, 1, 5])
    assert _first_apart(order, np.array([3, 1, 7]), np.array([7, 3, 7])) == [7, 9, 1, 5]
    assert _first_apart(order, np.array([], int), np.array([], int)) == [7, 3, 9, 1, 5]
    assert _first_apart(order[:0], np.array([], int), np.array([], int)) == []
