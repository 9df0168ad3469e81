"""The euclidean silhouette on a grid of block pairs against all pairs."""

import numpy as np
import pytest

from rtml.operators.metrics_clu import silhouette_euclidean


def plain(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        means = {k: d[i][c == k].sum() / ((c == k).sum() - (k == c[i])) if (c == k).sum() > (k == c[i])
                 else None for k in set(c)}
        a = means.pop(c[i])
        b = min(means.values(), default=None)
        out.append(0.0 if a is None or b is None or max(a, b) <= 0 else (b - a) / max(a, b))
    return out


@pytest.mark.parametrize("block", [2000, 13, 1])
def test_all_blocks(spark, block):
    draw = np.random.default_rng(0)
    n = 60 if block > 1 else 12
    x, c = draw.normal(size=(n, 3)), draw.integers(0, 4, n)
    c[0] = 9  # alone in its cluster
    x[2] = x[1]
    df = spark.createDataFrame([(i, p.tolist(), int(k)) for i, (p, k) in enumerate(zip(x, c))],
                               "id long, v array<double>, c long").repartition(3)
    found = silhouette_euclidean(df, "v", "c", "id", block)
    assert found.columns == ["id", "v", "c", "silhouette"]
    rows = {r.id: r.silhouette for r in found.collect()}
    assert [rows[i] for i in range(n)] == pytest.approx(plain(x, c), abs=1e-9)


def test_one_cluster_and_nothing(spark):
    df = spark.createDataFrame([(1, [0.0], 1), (2, [5.0], 1), (2, [5.0], 1)],
                               "id long, v array<double>, c long")
    assert [r.silhouette for r in silhouette_euclidean(df, "v", "c", "id").collect()] == [0.0] * 3
    assert silhouette_euclidean(df.where("false"), "v", "c", "id").count() == 0
