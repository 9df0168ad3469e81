"""Range and as-of joins against all pairs, with nulls, ties, hot keys and forced chunks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rtml.operators import joins as J
from rtml.plans.sqlguard import guarded


def points(seed, n, hot=0.4):
    draw = random.Random(seed)
    return [(i, draw.choice(["h"] if draw.random() < hot else ["a", "b", None]),
             draw.choice([None, float("nan"), float("inf")]) if draw.random() < 0.05
             else draw.randrange(200) / 2) for i in range(n)]


def ranges(seed, n):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        start = draw.randrange(200) / 2
        length = draw.choice([0, 0.5, 1, 3, 40, 150, -1])
        out.append((i, draw.choice(["h", "a", "b", None]), None if draw.random() < 0.05 else start,
                    start + length))
    return out


def good(x):
    return x is not None and x == x and abs(x) < float("inf")


def within(p, r, closed=True):
    return p[1] is not None and p[1] == r[1] and good(p[2]) and good(r[2]) and \
        r[2] <= p[2] and (p[2] <= r[3] if closed else p[2] < r[3])


@pytest.fixture(scope="module")
def tables(spark):
    p, r = points(1, 300), ranges(2, 120)
    return p, r, spark.createDataFrame(p, "id long, k string, x double"), \
        spark.createDataFrame(r, "id long, k string, x double, y double")


@pytest.mark.parametrize("hot", [500_000, 3])
@pytest.mark.parametrize("closed", [True, False])
def test_interval_join(tables, hot, closed):
    p, r, left, right = tables
    found = J.interval_join(left, right, "x", "x", "y", ["k"], closed=closed, hot_rows=hot)
    assert found.columns == ["id", "k", "x", "id_r", "k_r", "x_r", "y"]
    assert sorted((a.id, a.id_r) for a in found.collect()) == \
        sorted((a[0], b[0]) for a in p for b in r if within(a, b, closed))


def test_interval_join_keeps_lonely_points(tables):
    p, r, left, right = tables
    found = J.interval_join(left, right.where("id < 20"), "x", "x", "y", ["k"], how="left")
    want = []
    for a in p:
        hits = [b[0] for b in r[:20] if within(a, b)]
        want += [(a[0], h) for h in hits or [None]]
    key = lambda t: (t[0], t[1] is None, t[1] or 0)
    assert sorted(((a.id, a.id_r) for a in found.collect()), key=key) == sorted(want, key=key)


def test_interval_join_without_keys_and_rows(tables):
    p, r, left, right = tables
    found = J.interval_join(left, right, "x", "x", "y")
    want = sum(good(a[2]) and good(b[2]) and b[2] <= a[2] <= b[3] for a in p for b in r)
    assert found.count() == want
    assert J.interval_join(left, right.where("false"), "x", "x", "y", ["k"]).count() == 0
    assert J.interval_join(left.where("false"), right, "x", "x", "y", ["k"]).count() == 0
    assert J.interval_join(left, right.where("false"), "x", "x", "y", ["k"], how="left").count() == 300


@pytest.mark.parametrize("hot", [500_000, 2])
def test_overlap_join(tables, spark, hot):
    _, r, _, right = tables
    other = ranges(7, 80)
    found = J.overlap_join(right, spark.createDataFrame(other, right.schema), ("x", "y"), ("x", "y"),
                           ["k"], hot_rows=hot)
    want = [(a[0], b[0]) for a in r for b in other if a[1] is not None and a[1] == b[1] and
            good(a[2]) and good(b[2]) and a[2] <= a[3] and b[2] <= b[3] and
            a[2] <= b[3] and b[2] <= a[3]]
    assert sorted((a.id, a.id_r) for a in found.collect()) == sorted(want)


def plain_asof(left, right, tolerance=None, strict=False, forward=False):
    out = {}
    for i, k, x in left:
        best = None
        for j, kr, y in right:
            if kr != k or not good(x) or not good(y):
                continue
            a, b = (-x, -y) if forward else (x, y)
            if (b < a or (b == a and not strict)) and \
                    (tolerance is None or a - b <= tolerance) and \
                    (best is None or (b, j) > best[:2]):
                best = (b, j)
        out[i] = best and best[1]
    return out


@pytest.mark.parametrize("chunks", [None, 7])
@pytest.mark.parametrize("rule", [{}, {"tolerance": 2.5}, {"strict": True},
                                  {"direction": "forward"}])
def test_asof_join(spark, rule, chunks):
    a, b = points(3, 250), points(4, 120)
    left, right = (spark.createDataFrame(t, "id long, k string, x double") for t in (a, b))
    found = J.asof_join(left, right, "x", "x", ["k"], chunks=chunks, **rule)
    assert found.columns == ["id", "k", "x", "id_r", "k_r", "x_r"]
    want = plain_asof(a, b, rule.get("tolerance"), rule.get("strict", False), "direction" in rule)
    assert {r.id: r.id_r for r in found.collect()} == want


def test_asof_join_of_times(spark):
    day = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, day), (2, day + dt.timedelta(seconds=90)), (3, None)],
                                 "id long, ts timestamp")
    right = spark.createDataFrame([(10, day - dt.timedelta(seconds=1)),
                                   (11, day + dt.timedelta(seconds=20))], "price long, ts timestamp")
    found = J.asof_join(left, right, "ts", "ts", tolerance=60)
    assert {r.id: r.price for r in found.collect()} == {1: 10, 2: None, 3: None}
    assert J.asof_join(left, right.where("false"), "ts", "ts").where("price IS NULL").count() == 3


def test_no_nested_loop(tables):
    _, _, left, right = tables
    for df in (J.interval_join(left, right, "x", "x", "y"), J.asof_join(left, right, "x", "x"),
               J.overlap_join(right, right, ("x", "y"), ("x", "y"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_joins_are_relations_of_the_guard(tables):
    p, r, left, right = tables
    pairs = J.interval_join(left, right, "x", "x", "y", ["k"])
    found = guarded(left, "SELECT d.k, COUNT(*) AS n FROM pairs p JOIN data d ON d.id = p.id "
                          "GROUP BY d.k", relations={"pairs": pairs})
    want = {}
    for a in p:
        n = sum(within(a, b) for b in r)
        if n:
            want[a[1]] = want.get(a[1], 0) + n
    assert {x.k: x.n for x in found.collect()} == want
    with pytest.raises(ValueError, match="can be read"):
        guarded(left, "SELECT * FROM pairs")
    with pytest.raises(ValueError, match="name"):
        guarded(left, "SELECT * FROM data", relations={"a b": pairs})
    with pytest.raises(ValueError, match="name"):
        guarded(left, "SELECT * FROM data", relations={"data": pairs})


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("small", ["0", "33554432"])
def test_pair_totals_are_those_of_the_pairs(spark, closed, small):
    """Counted pairs equal made ones: equal places, empty ranges, nulls, odd values, repeated ranges."""
    draw = random.Random(5)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    points = spark.createDataFrame(
        [(float(draw.randint(0, 40)) if i % 13 else odd[i % 4], "ab"[i % 2] if i % 11 else None,
          odd[i % 4] if i % 17 == 0 and i % 2 else draw.random()) for i in range(400)],
        "x double, k string, v double")
    made = [(float(a), float(a + draw.randint(-1, 6)), "ab"[a % 2], draw.choice(["g", "h", None]))
            for a in range(40)]
    ranges = spark.createDataFrame([*made, *made[:9], (None, 3.0, "a", "g"), (90.0, 99.0, "a", "none")],
                                   "low double, high double, k string, g string")
    pairs = J.interval_join(points, ranges, "x", "low", "high", ["k"], closed=closed)
    want = {r.g: (r.n, r.v) for r in pairs.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")).collect()}
    spark.conf.set("rtml.chunk.minBytes", small)
    try:
        met = J.interval_join(points, ranges, "x", "low", "high", ["k"], closed=closed, by=["g"], sums=["v"])
        found = {r.g: (r.n, r.v) for r in met.collect()}
    finally:
        spark.conf.unset("rtml.chunk.minBytes")
    assert set(found) == set(want) and "none" not in found
    for g, (n, v) in want.items():
        assert found[g][0] == n and found[g][1] == pytest.approx(v, rel=1e-9, nan_ok=True)
