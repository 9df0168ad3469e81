"""Drift detection on a keyed error stream with an adaptive window.

Rows are first reduced to small block summaries inside each input partition (no shuffle), so the
stateful step sees a few rows per key and batch even when one key holds most of the stream.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

BLOCK_ROWS = 64
MAX_BLOCKS = 64
DRIFT_DELTA = 0.002
WARNING_DELTA = 0.01

# The keyed step needs this state store; it is a default of this package's sessions.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

SUMMARY = "key string, first_at long, n long, total double, squares double"
OUTPUT = "key string, rows long, window_rows long, mean double, drift boolean, warning boolean"


def block_summaries(df: DataFrame, key: str, order: str, error: str) -> DataFrame:
    """Count, sum and sum of squares per key and order block, made within each partition."""
    def summarise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            x = part["_e"].astype(float)
            table = pd.DataFrame({"key": part["_k"].astype(str), "at": part["_o"], "n": 1,
                                  "total": x, "squares": x * x,
                                  "block": part["_o"] // BLOCK_ROWS})
            sums = table.groupby(["key", "block"], as_index=False).agg(
                first_at=("at", "min"), n=("n", "sum"), total=("total", "sum"),
                squares=("squares", "sum"))
            yield sums[["key", "first_at", "n", "total", "squares"]]

    return df.selectExpr(f"cast({key} as string) as _k", f"cast({order} as long) as _o",
                         f"cast({error} as double) as _e").mapInPandas(summarise, SUMMARY)


def cut_found(blocks: list[list[float]], delta: float) -> bool:
    """Whether some cut of the window separates two significantly different means."""
    n = sum(b[0] for b in blocks)
    if n < 2 or len(blocks) < 2:
        return False
    total, squares = sum(b[1] for b in blocks), sum(b[2] for b in blocks)
    variance = max(squares / n - (total / n) ** 2, 0.0)
    confidence = math.log(2.0 * math.log(max(n, 3)) / delta)
    n0 = s0 = 0.0
    for b in blocks[:-1]:
        n0, s0 = n0 + b[0], s0 + b[1]
        n1, s1 = n - n0, total - s0
        m = 1.0 / (1.0 / n0 + 1.0 / n1)
        bound = math.sqrt(2.0 / m * variance * confidence) + 2.0 / (3.0 * m) * confidence
        if abs(s0 / n0 - s1 / n1) > bound:
            return True
    return False


def add_block(blocks: list[list[float]], block: list[float]) -> tuple[list, bool, bool]:
    """Window after one more block, and whether it drifted or came close.

    Old blocks are dropped while a cut is found; beyond MAX_BLOCKS the oldest pair is merged.
    """
    blocks = [*blocks, block]
    warning = cut_found(blocks, WARNING_DELTA)
    drift = False
    while len(blocks) > 1 and cut_found(blocks, DRIFT_DELTA):
        drift, blocks = True, blocks[1:]
    if len(blocks) > MAX_BLOCKS:
        sizes = [blocks[i][0] + blocks[i + 1][0] for i in range(len(blocks) - 1)]
        i = sizes.index(min(sizes))
        merged = [a + b for a, b in zip(blocks[i], blocks[i + 1])]
        blocks = [*blocks[:i], merged, *blocks[i + 2:]]
    return blocks, drift, warning


class DriftProcessor(StatefulProcessor):
    """Adaptive window per key; the state is at most MAX_BLOCKS small blocks."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.window = handle.getValueState("window", "rows long, blocks string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, blocks = 0, []
        if self.window.exists():
            seen, text = self.window.get()
            blocks = json.loads(text)
        drift = warning = False
        parts = [p for p in rows if not p.empty]
        table = pd.concat(parts).sort_values("first_at") if parts else pd.DataFrame()
        for r in table.itertuples(index=False):
            blocks, d, w = add_block(blocks, [float(r.n), float(r.total), float(r.squares)])
            seen += int(r.n)
            drift, warning = drift or d, warning or w
        self.window.update((seen, json.dumps(blocks)))
        n = sum(b[0] for b in blocks)
        yield pd.DataFrame({"key": [key[0]], "rows": [seen], "window_rows": [int(n)],
                            "mean": [sum(b[1] for b in blocks) / n if n else 0.0],
                            "drift": [drift], "warning": [warning]})

    def close(self) -> None:
        pass


def detect_drift(stream: DataFrame, key: str, order: str, error: str) -> DataFrame:
    """One row per key and batch: rows seen, window size and mean, drift and warning flags."""
    return block_summaries(stream, key, order, error).groupBy("key").transformWithStateInPandas(
        DriftProcessor(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")
