"""Exact ROC AUC of every trailing window of rows, by order statistics over score ranks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rtml.plans.prefix import overlapped, row_numbers, with_chunk


class RankTree:
    """Counts of values below a bound inside any stretch of a sequence of ranks.

    One level per bit of the ranks, each a running count of zero bits over the sequence in the order
    of the bits above: a query walks the levels, and all queries walk them together.
    """

    def __init__(self, ranks: np.ndarray, size: int):
        self.bits = max(int(size).bit_length(), 1)
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            one = (ranks >> bit) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - one)]))
            ranks = np.concatenate([ranks[one == 0], ranks[one == 1]])

    def below(self, first: np.ndarray, stop: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the places ``first <= i < stop`` hold a rank under ``bound`` (at most size)."""
        found = np.zeros(len(bound), np.int64)
        for level, zeros in enumerate(self.zeros):
            high = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = zeros[first], zeros[stop]
            found += np.where(high, b - a, 0)
            first = np.where(high, first - a + zeros[-1], a)
            stop = np.where(high, stop - b + zeros[-1], b)
        return found


def window_areas(label: np.ndarray, score: np.ndarray, rows: int) -> tuple:
    """Positives, negatives and twice the ordered pairs of the last ``rows`` rows at every row.

    A pair is a positive and a negative; it counts 2 if the positive scores higher and 1 on a tie. A
    window differs from the one before by the pairs of the row that enters and of the one that
    leaves; both are counted by two queries each to the trees of the positives and the negatives.
    """
    n = len(label)
    _, rank = np.unique(score, return_inverse=True)
    size = int(rank.max()) + 1 if n else 0
    at = np.arange(n)
    trees, places = {}, {}
    for y in (0, 1):
        trees[y] = RankTree(rank[label == y], size)
        places[y] = np.concatenate([[0], np.cumsum(label == y)])

    def pairs(who: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Pairs of rows ``who`` with rows of the other label in ``first <= i < stop``."""
        out = np.zeros(len(who), np.int64)
        for y in (0, 1):
            mine = np.flatnonzero(label[who] == y)
            other, spots = trees[1 - y], places[1 - y]
            a, b = spots[first[mine]], spots[stop[mine]]
            under, upto = other.below(a, b, rank[who[mine]]), other.below(a, b, rank[who[mine]] + 1)
            # 2 x lower + ties for a positive row, 2 x higher + ties for a negative one
            out[mine] = under + upto if y else 2 * (b - a) - under - upto
        return out

    start = np.maximum(at - rows, 0)
    entered = pairs(at, start, at)
    gone = np.arange(max(n - rows, 0))
    change = entered.copy()
    # at row t the row t - rows leaves; what entered was still paired with it
    change[rows:] -= pairs(gone, gone + 1, np.minimum(gone + rows + 1, n))
    first = np.maximum(at - rows + 1, 0)
    return (places[1][at + 1] - places[1][first], places[0][at + 1] - places[0][first],
            np.cumsum(change))


def sliding_auc(df: DataFrame, keys: list[str], order: str, label: str, score: str,
                rows: int = 5000, rows_per_block: int = 50_000) -> DataFrame:
    """ROC AUC of the last ``rows`` rows of the key at every row: keys, ``order``, ``positives``,
    ``negatives``, ``auc`` (null where a class is missing).

    Rows without label or score, or with a NaN score, are left out. Positions are cut into blocks
    that repeat the ``rows`` rows before them, so a task holds one block at a time whatever the size
    of a key, and the work per row is that of a few look-ups per bit of the block's ranks.
    """
    slim = df.select(*keys, order, F.col(label).cast("int").alias("_y"),
                     F.col(score).cast("double").alias("_p")) \
        .where("_y IN (0, 1) AND _p IS NOT NULL AND NOT isnan(_p)")
    numbered = row_numbers(with_chunk(slim, order), keys, [order], out="_rn")
    blocks = overlapped(numbered, "_rn", max(rows_per_block, 2 * rows), rows)

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_rn")
        pos, neg, twice = window_areas(frame["_y"].to_numpy(), frame["_p"].to_numpy(), rows)
        both = 2.0 * pos * neg
        out = frame[[*keys, order]].copy()
        out["positives"], out["negatives"] = pos, neg
        out["auc"] = np.divide(twice, both, out=np.full(len(both), np.nan), where=both > 0)
        return out[frame["_own"].to_numpy()]

    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [*keys, order])
    found = blocks.groupBy(*keys, "_block").applyInPandas(
        block, f"{shape}, positives long, negatives long, auc double")
    return found.withColumn("auc", F.when(~F.isnan("auc"), F.col("auc")))
