"""Online seasonal forecasts per series: fading normal equations, merged batch by batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rtml.plans.prefix import overlapped, row_numbers, with_chunk
from rtml.session import ensure_checkpoint_dir
from rtml.streaming.statelog import StateLog


class SeriesForecaster:
    """Autoregression on chosen lags for every series of a stream.

    ``y(t) = c + sum of b_i * y(t - lag_i)``, on differences of first order if ``differences``. A
    season enters as a lag. State per series: the sums of products of the inputs and the target,
    multiplied by ``fade`` with every batch that has rows of the series, and the last values. Sums
    merge, so a batch is one grouped aggregation whatever its size, and a hot series is cut into
    blocks like any other. Learning all batches with ``fade`` 1 is least squares over all rows.

    Rows without a value, a series or an order are left out. ``order`` is a whole number that rises
    from batch to batch; a row that comes late counts as if it came in the order of its batch.
    """

    def __init__(self, spark: SparkSession, path: str, series: str, order: str, value: str,
                 lags: tuple[int, ...] = (1, 2, 7), differences: bool = False, fade: float = 1.0,
                 ridge: float = 1e-12, rows_per_block: int = 200_000):
        if not lags or min(lags) < 1 or len(set(lags)) < len(lags):
            raise ValueError("lags must be different whole numbers from 1")
        ensure_checkpoint_dir(spark)
        self.spark, self.series, self.order, self.value = spark, series, order, value
        self.lags, self.differences, self.fade, self.ridge = tuple(lags), differences, fade, ridge
        self.rows_per_block = rows_per_block
        self.depth = max(lags) + differences
        self.moments = StateLog(spark, f"{path}/moments",
                                "series string, n double, xx array<double>, xy array<double>",
                                whole=True)
        self.tails = StateLog(spark, f"{path}/tails", "series string, place long, y double",
                              whole=True)

    def _inputs(self, rows: DataFrame) -> DataFrame:
        """Rows of the batch (``_new``) with target and inputs, where all lags exist."""
        numbered = row_numbers(with_chunk(rows, "place"), ["series"], ["place"], out="_rn")
        blocks = overlapped(numbered, "_rn", max(self.rows_per_block, 2 * self.depth), self.depth)
        w = Window.partitionBy("series", "_block").orderBy("_rn")

        def at(lag: int):
            y = F.lag("y", lag).over(w) if lag else F.col("y")
            return y - F.lag("y", lag + 1).over(w) if self.differences else y

        names = [f"_x{i}" for i in range(len(self.lags))]
        out = blocks.select("series", "_new", "_own", at(0).alias("_y"),
                            *[at(lag).alias(n) for lag, n in zip(self.lags, names)])
        known = out.where("_own AND _new")
        for n in names:
            known = known.where(F.col(n).isNotNull())
        return known.select("series", "_y", F.array(F.lit(1.0), *names).alias("x"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        last = self.tails.version(batch_id - 1)
        start = (last.agg(F.max("place")).first()[0] or 0) + 1
        least = batch.agg(F.min(F.col(self.order).cast("long"))).first()[0] or 0
        fresh = batch.select(
            F.col(self.series).cast("string").alias("series"),
            (F.col(self.order).cast("long") - least + start).alias("place"),
            F.col(self.value).cast("double").alias("y"), F.lit(True).alias("_new")) \
            .where("series IS NOT NULL AND place IS NOT NULL AND y IS NOT NULL AND NOT isnan(y)")
        rows = last.withColumn("_new", F.lit(False)).unionByName(fresh)
        p = len(self.lags) + 1
        x = [F.get("x", F.lit(i)) for i in range(p)]
        found = self._inputs(rows).groupBy("series").agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.array(*[F.sum(x[i] * x[j]) for i in range(p) for j in range(p)]).alias("xx"),
            F.array(*[F.sum(x[i] * F.col("_y")) for i in range(p)]).alias("xy"))
        old = self.moments.version(batch_id - 1).select(
            "series", F.col("n").alias("n0"), F.col("xx").alias("xx0"), F.col("xy").alias("xy0"))

        def merged(now: str, before: str):
            return F.when(F.col(before).isNull(), F.col(now)).when(F.col(now).isNull(), F.col(before)) \
                .otherwise(F.zip_with(before, now, lambda a, b: a * self.fade + b))

        self.moments.write(old.join(found, "series", "full").select(
            "series", F.when(F.col("n0").isNull(), F.col("n")).when(F.col("n").isNull(), F.col("n0"))
            .otherwise(F.col("n0") * self.fade + F.col("n")).alias("n"),
            merged("xx", "xx0").alias("xx"), merged("xy", "xy0").alias("xy")), batch_id)
        numbered = row_numbers(with_chunk(rows.withColumn("_back", -F.col("place")), "_back"),
                               ["series"], ["_back"], out="_from_end")
        self.tails.write(numbered.where(F.col("_from_end") <= self.depth)
                         .select("series", "place", "y"), batch_id)

    def coefficients(self, batch_id: int) -> DataFrame:
        """``series, n, coefficients`` (constant first, then one per lag) after a batch.

        Series with fewer rows than coefficients, or whose inputs do not vary, get the solution of
        least size (a ridge of ``ridge``, with all inputs scaled to the same mean square).
        """
        p, ridge = len(self.lags) + 1, self.ridge

        def solve(batches):
            for batch in batches:
                k = batch.num_rows
                xx = batch.column("xx").flatten().to_numpy(zero_copy_only=False).reshape(k, p, p)
                xy = batch.column("xy").flatten().to_numpy(zero_copy_only=False).reshape(k, p, 1)
                size = np.sqrt(np.maximum(np.diagonal(xx, axis1=1, axis2=2), 1e-300))[:, :, None]
                even = xx / size / size.transpose(0, 2, 1) + ridge * np.eye(p)
                b = np.linalg.solve(even, xy / size) / size if k else xy
                yield pa.RecordBatch.from_arrays(
                    [batch.column("series"), batch.column("n"), pa.ListArray.from_arrays(
                        pa.array(np.arange(k + 1) * p, pa.int32()), pa.array(b.ravel()))],
                    names=["series", "n", "coefficients"])

        return self.moments.version(batch_id).mapInArrow(
            solve, "series string, n double, coefficients array<double>")

    def forecast(self, batch_id: int, steps: int = 1) -> DataFrame:
        """``series, step, forecast`` for the next ``steps`` places; each uses the ones before it.

        Series that do not have all lags yet are left out.
        """
        lags, diff, depth = self.lags, self.differences, self.depth
        tails = self.tails.version(batch_id).groupBy("series").agg(
            F.sort_array(F.collect_list(F.struct("place", "y"))).alias("t")) \
            .select("series", F.col("t.y").alias("tail")).where(F.size("tail") == depth)
        ready = self.coefficients(batch_id).join(tails, "series")

        def run(batches):
            for batch in batches:
                k = batch.num_rows
                b = np.stack(batch.column("coefficients").to_pylist()) if k else np.empty((0, 1))
                y = np.stack(batch.column("tail").to_pylist()) if k else np.empty((0, depth))
                z = np.diff(y, axis=1) if diff else y
                out, level = [], y[:, -1]
                for _ in range(steps if k else 0):
                    nxt = b[:, 0] + sum(b[:, i + 1] * z[:, -lag] for i, lag in enumerate(lags))
                    z = np.concatenate([z, nxt[:, None]], axis=1)
                    level = level + nxt if diff else nxt
                    out.append(level)
                names = batch.column("series").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names * len(out), pa.string()),
                     pa.array(np.repeat(np.arange(1, len(out) + 1), k), pa.int32()),
                     pa.array(np.concatenate(out) if out else np.empty(0))],
                    names=["series", "step", "forecast"])

        return ready.select("series", "coefficients", "tail").mapInArrow(
            run, "series string, step int, forecast double")
