"""Exact sliding ROC AUC and the rank tree behind it against plain counting."""

import numpy as np
import pytest

from rtml.operators.sliding import RankTree, sliding_auc, window_areas


def plain_auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    if not len(pos) or not len(neg):
        return None
    d = pos[:, None] - neg[None, :]
    return float(((d > 0) + 0.5 * (d == 0)).mean())


def test_rank_tree_counts():
    draw = np.random.default_rng(0)
    ranks = draw.integers(0, 37, 500)
    tree = RankTree(ranks, 37)
    a = draw.integers(0, 501, 300)
    b = np.maximum(a, draw.integers(0, 501, 300))
    bound = draw.integers(0, 38, 300)
    assert tree.below(a, b, bound).tolist() == \
        [int((ranks[i:j] < v).sum()) for i, j, v in zip(a, b, bound)]


@pytest.mark.parametrize("rows", [1, 2, 7, 50, 1000])
def test_window_areas(rows):
    draw = np.random.default_rng(rows)
    label, score = draw.integers(0, 2, 300), draw.integers(0, 12, 300) / 4
    pos, neg, twice = window_areas(label, score, rows)
    for t in range(300):
        y, s = label[max(0, t - rows + 1):t + 1], score[max(0, t - rows + 1):t + 1]
        assert (pos[t], neg[t]) == (y.sum(), (1 - y).sum())
        want = plain_auc(y, s)
        assert want is None or abs(twice[t] / (2 * pos[t] * neg[t]) - want) < 1e-12


@pytest.mark.parametrize("block", [50_000, 64])
def test_sliding_auc(spark, chunked, block):
    draw = np.random.default_rng(4)
    rows = [(int(i), "ab"[int(k)], int(y) if i % 17 else None,
             float("nan") if i % 23 == 0 else float(p)) for i, (k, y, p) in
            enumerate(zip(draw.integers(0, 2, 400), draw.integers(0, 2, 400),
                          draw.integers(0, 9, 400) / 2))]
    df = spark.createDataFrame(rows, "at long, k string, y int, p double").repartition(5)
    found = {(r.k, r.at): r for r in sliding_auc(df, ["k"], "at", "y", "p", 30, block).collect()}
    for k in "ab":
        kept = [r for r in rows if r[1] == k and r[2] is not None and r[3] == r[3]]
        for i, r in enumerate(kept):
            y, s = (np.array([x[j] for x in kept[max(0, i - 29):i + 1]]) for j in (2, 3))
            got, want = found.pop((k, r[0])), plain_auc(y, s)
            assert (got.positives, got.negatives) == (y.sum(), (1 - y).sum())
            assert got.auc == want if want is None else abs(got.auc - want) < 1e-12
    assert not found
    assert sliding_auc(df.where("false"), ["k"], "at", "y", "p", 30).count() == 0
