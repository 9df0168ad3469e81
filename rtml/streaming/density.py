"""Density clustering of a stream: micro-clusters of a radius, joined where they share rows.

A row belongs to every micro-cluster whose center lies within the radius. Rows near none make new
ones. Weights and the rows that two micro-clusters share fade from batch to batch; where the share is
large enough the two are one cluster. The state is one row per micro-cluster and one per pair that
shares rows, whatever the number of rows or dimensions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rtml.operators.graph import connected
from rtml.session import ensure_checkpoint_dir, scratch_path
from rtml.streaming.statelog import StateLog

#: Rows that are looked at together on the driver to choose new centers from, how much more are with each
#: further handful, whose close pairs the tasks find, and the most.
LEADERS, MORE, MOST = 2000, 16, 1 << 18
#: Rows and centers of one cell that are compared in one block, about; distances that are held at once.
BLOCK, HELD = 8192, 1 << 21
#: Cells whose blocks are counted on the driver.
CELLS = 100_000
_CENTERS = "mc long, center array<double>, weight double"


def _dot(x: str, axis: np.ndarray) -> Column:
    """Projection of an array column; missing places count 0."""
    products = F.zip_with(x, F.array(*[F.lit(float(a)) for a in axis]),
                          lambda a, b: F.coalesce(a * b, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder, where a checkpoint makes them twice."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in table.column(name).chunks]) if table.num_rows else pa.array([])
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(table.num_rows, -1)


def _close(radius: float):
    """Pairs of a block of rows and a block of centers that are at most a radius apart.

    A matrix product leaves out pairs that are surely too far; the others are summed place by place.
    """
    def run(rows: pa.Table, centers: pa.Table) -> pa.Table:
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        if rows.num_rows and centers.num_rows:
            x, c = _numbers(rows, "_x"), _numbers(centers, "center")
            xx, cc = (x * x).sum(1), (c * c).sum(1)
            step = max(1, HELD // len(c))
            for first in range(0, len(x), step):
                size = xx[first:first + step, None] + cc[None, :]
                i, j = np.nonzero(size - 2.0 * x[first:first + step] @ c.T <=
                                  radius ** 2 + 1e-9 * (size + radius ** 2))
                i += first
                d2 = np.zeros(len(i))
                for place in range(x.shape[1]):
                    gap = x[i, place] - c[j, place]
                    d2 += gap * gap
                near = d2 <= radius ** 2
                found.append((i[near], j[near], d2[near]))
        i, j, d2 = (np.concatenate(v) for v in zip(*found))
        return pa.table({"_row": rows.column("_row").take(pa.array(i)), "_x": rows.column("_x").take(pa.array(i)),
                         "mc": centers.column("mc").take(pa.array(j)), "d2": pa.array(d2)})
    return run


def _first_apart(order: np.ndarray, rows: np.ndarray, others: np.ndarray) -> list[int]:
    """Of ``order``, what no earlier one chosen is close to; ``rows`` and ``others`` are close pairs."""
    place = {r: i for i, r in enumerate(order.tolist())}
    a, b = (np.array([place[r] for r in v.tolist()], int) for v in (rows, others))
    early, late = np.minimum(a, b), np.maximum(a, b)
    by = np.argsort(early, kind="stable")
    late, bounds = late[by], np.searchsorted(early[by], np.arange(len(order) + 1))
    open_ = np.ones(len(order), bool)
    for i in np.unique(early[early < np.maximum(a, b)]):
        if open_[i]:
            covered = late[bounds[i]:bounds[i + 1]]
            open_[covered[covered > i]] = False
    return order[open_].tolist()


class DensityClusters:
    """``batch -> state``; see the module for the rules.

    ``radius``: reach of a micro-cluster. ``fading``: weights are multiplied by 2^-fading every batch.
    ``intersection``: two micro-clusters are linked if the rows they share are at least this part of
    their mean weight: of evenly spread rows, two reaches whose centers are a radius apart share 0.5 on
    a line, 0.39 in the plane and less in space, so more dimensions want a smaller part. Every
    ``cleanup`` batches micro-clusters lighter than ``min_weight``, and pairs lighter than
    ``intersection * min_weight``, are forgotten.
    """

    def __init__(self, spark: SparkSession, path: str, vec: str, radius: float, dims: int,
                 fading: float = 0.05, intersection: float = 0.5, cleanup: int = 4,
                 min_weight: float = 1.0, axes: int = 3, seed: int = 42):
        ensure_checkpoint_dir(spark)
        self.spark, self.vec, self.radius, self.dims = spark, vec, radius, dims
        self.fade, self.intersection = 2.0 ** -fading, intersection
        self.cleanup, self.min_weight = cleanup, min_weight
        draw = np.random.default_rng(seed).normal(size=(min(axes, dims), dims))
        self.axes = np.linalg.qr(draw.T)[0].T  # unit vectors: a projection never lengthens a distance
        self.centers = StateLog(spark, f"{path}/centers", _CENTERS, whole=True)
        self.shared = StateLog(spark, f"{path}/shared", "a long, b long, weight double", whole=True)
        self.history = StateLog(spark, f"{path}/history",
                                "rows long, n_micro_clusters long, n_clusters long")

    def _cells(self, x: str) -> list[Column]:
        return [F.floor(_dot(x, axis) / self.radius) for axis in self.axes]

    def near(self, rows: DataFrame, centers: DataFrame) -> DataFrame:
        """``_row, _x, mc, d2`` of all rows and centers at most a radius apart.

        Points that close differ by at most one cell on every axis. The few centers are sent to all
        neighbouring cells, so that each row looks into its own one only; then the distance decides.
        """
        steps = F.array(*[F.lit(v) for v in (-1, 0, 1)])
        placed = centers.select("mc", "center", *[c.alias(f"_c{i}") for i, c in
                                                  enumerate(self._cells("center"))])
        for i in range(len(self.axes)):
            placed = placed.withColumn("_s", F.explode(steps)) \
                .withColumn(f"_c{i}", F.col(f"_c{i}") + F.col("_s")).drop("_s")
        names = [f"_c{i}" for i in range(len(self.axes))]
        probes = rows.select("_row", "_x", *[c.alias(n) for n, c in zip(names, self._cells("_x"))])
        # a crowded cell is cut into blocks, and every block of its rows meets every block of its centers;
        # cells without rows, or without centers, are left out
        blocks = [df.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(n))
                  for df, n in ((probes, "_rbs"), (placed, "_cbs"))]
        cells = blocks[0].join(blocks[1], names).select(*names, "_rbs", "_cbs")
        few = cells.limit(CELLS + 1).collect()
        if len(few) <= CELLS:
            cells = F.broadcast(self.spark.createDataFrame(few, cells.schema).coalesce(1))
        probes, placed = (
            df.join(cells, names)
            .withColumn(own, F.pmod(F.xxhash64(F.col(key)), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("_rbs", "_cbs")
            for df, key, own, other in ((probes, "_row", "_rb", "_cb"), (placed, "mc", "_cb", "_rb")))
        by = [*names, "_rb", "_cb"]
        return probes.groupBy(*by).cogroup(placed.groupBy(*by)).applyInArrow(
            _close(self.radius), "_row long, _x array<double>, mc long, d2 double")

    def _new_centers(self, rows: DataFrame, centers: DataFrame, first: int,
                     met: DataFrame | None = None) -> DataFrame:
        """Centers so that every row is near one: uncovered rows, in a random order, that are further than
        the radius from all chosen before them. ``met``: what is near of rows and ``centers``, if known.

        They are chosen in handfuls. The first is thinned on the driver; most rows of a dense place are
        covered by its first center. Those that are left have few others near them in a handful
        not many times larger, so the driver is sent the close pairs of the next one. Handfuls
        are bounded.
        """
        met = self.near(rows, centers) if met is None else met
        left = _kept(rows.join(met.select("_row").distinct(), "_row", "left_anti"), "left")
        found, taken, n = None, 0, LEADERS
        while True:
            by = [F.xxhash64("_row"), F.col("_row")]
            handful = left.orderBy(*by).limit(n)
            if n == LEADERS:
                sample = handful.collect()
                order, x = np.array([r._row for r in sample], int), np.array([r._x for r in sample])
                open_, picked = np.ones(len(x), bool), []
                for i in range(len(x)):
                    if open_[i]:
                        picked.append(order[i].item())
                        open_ &= ((x - x[i]) ** 2).sum(axis=1) > self.radius ** 2
            else:
                handful = _kept(handful, "handful")
                order = handful.select("_row").orderBy(*by).toArrow().column(0).to_numpy()
                pairs = self.near(handful, handful.select(F.col("_row").alias("mc"), F.col("_x").alias("center"))) \
                    .where("_row < mc").select("_row", "mc").toArrow()
                picked = _first_apart(order, *(pairs.column(c).to_numpy() for c in ("_row", "mc")))
            if picked:
                ids = self.spark.createDataFrame(
                    pa.table({"_row": picked, "mc": range(first + taken, first + taken + len(picked))}))
                here = _kept(left.join(F.broadcast(ids), "_row").select(
                    "mc", F.col("_x").alias("center"), F.lit(0.0).alias("weight")), "fresh")
                taken, found = taken + len(picked), here if found is None else found.unionByName(here)
            if len(order) < n:
                return self.spark.createDataFrame([], _CENTERS) if found is None else found
            last = int(order[-1])
            at = F.xxhash64(F.lit(last).cast("long"))
            left = left.where((by[0] > at) | ((by[0] == at) & (by[1] > last)))
            left = _kept(left.join(self.near(left, here).select("_row").distinct(), "_row", "left_anti"), "left")
            n = min(n * MORE, MOST)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = _kept(batch.select(F.col(self.vec).cast("array<double>").alias("_x"))
                     .where(F.size("_x") == self.dims)
                     .where(~F.exists("_x", lambda v: v.isNull() | F.isnan(v)))
                     .withColumn("_row", F.monotonically_increasing_id()).select("_row", "_x"), "rows")
        old = self.centers.version(batch_id - 1)
        first = (old.agg(F.max("mc")).first()[0] or 0) + 1
        met = _kept(self.near(rows, old), "met")
        fresh = self._new_centers(rows, old, first, met)
        live = old.unionByName(fresh)
        met = met.unionByName(_kept(self.near(rows, fresh), "met"))
        counted = met.groupBy("mc").agg(F.count(F.lit(1)).alias("n"))
        best = met.groupBy("_row").agg(F.min(F.struct("d2", "mc")).alias("b"), F.first("_x").alias("_x"))
        pulled = best.groupBy(F.col("b.mc").alias("mc")).agg(
            F.count(F.lit(1)).alias("k"),
            vector_to_array(Summarizer.sum(array_to_vector("_x"))).alias("sums"))
        kept = F.col("weight") * self.fade
        moved = F.when(F.col("k").isNull(), F.col("center")).otherwise(F.zip_with(
            "center", "sums", lambda c, s: (c * kept + s) / (kept + F.col("k"))))
        now = live.join(counted, "mc", "left").join(pulled, "mc", "left").select(
            "mc", moved.alias("center"), (kept + F.coalesce("n", F.lit(0))).alias("weight"))
        ids = met.groupBy("_row").agg(F.sort_array(F.collect_list("mc")).alias("ids")) \
            .where("size(ids) > 1")
        pairs = ids.groupBy("ids").agg(F.count(F.lit(1)).alias("n")).select(
            "n", F.posexplode("ids").alias("_i", "a"), "ids") \
            .select("n", "a", F.explode(F.slice("ids", F.col("_i") + 2, F.size("ids"))).alias("b"))
        edges = self.shared.version(batch_id - 1).select("a", "b", F.col("weight") * self.fade) \
            .union(pairs.select("a", "b", F.col("n").cast("double"))).toDF("a", "b", "weight") \
            .groupBy("a", "b").agg(F.sum("weight").alias("weight"))
        if (batch_id + 1) % self.cleanup == 0:
            now = now.where(F.col("weight") >= self.min_weight)
            edges = edges.where(F.col("weight") >= self.intersection * self.min_weight)
        self.centers.write(now, batch_id)
        alive = self.centers.version(batch_id).select("mc")
        self.shared.write(edges.join(alive.withColumnRenamed("mc", "a"), "a", "left_semi")
                          .join(alive.withColumnRenamed("mc", "b"), "b", "left_semi")
                          .select("a", "b", "weight"), batch_id)
        sizes = self.clusters(batch_id).agg(
            F.count(F.lit(1)).alias("n_micro_clusters"),
            F.count_distinct("cluster").alias("n_clusters"))
        self.history.write(sizes.select(F.lit(rows.count()).alias("rows"), "n_micro_clusters",
                                        "n_clusters"), batch_id)

    def clusters(self, batch_id: int) -> DataFrame:
        """``mc, center, weight, cluster`` after a batch; a cluster is its smallest micro-cluster.

        Micro-clusters lighter than ``min_weight`` have no cluster yet.
        """
        centers = self.centers.version(batch_id)
        strong = centers.where(F.col("weight") >= self.min_weight).select("mc", "weight")
        links = self.shared.version(batch_id).withColumnRenamed("weight", "common") \
            .join(strong.toDF("a", "wa"), "a").join(strong.toDF("b", "wb"), "b") \
            .where(F.col("common") >= self.intersection * (F.col("wa") + F.col("wb")) / 2)
        groups = connected(strong.select("mc"), links.select("a", "b"))
        return centers.join(groups.toDF("mc", "cluster"), "mc", "left")

    def assign(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """``rows`` with ``cluster`` of their nearest center within the radius; null is noise."""
        numbered = _kept(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        points = numbered.select("_row", F.col(self.vec).cast("array<double>").alias("_x")) \
            .where(F.size("_x") == self.dims)
        found = self.clusters(batch_id)
        best = self.near(points, found.select("mc", "center")).groupBy("_row") \
            .agg(F.min(F.struct("d2", "mc")).alias("b")).select("_row", F.col("b.mc").alias("mc"))
        return numbered.join(best.join(found.select("mc", "cluster"), "mc").drop("mc"), "_row", "left") \
            .drop("_row")
