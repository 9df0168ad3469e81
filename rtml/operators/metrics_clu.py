"""Clustering metrics from per-cluster summaries.

Only cluster summaries (clusters x dimensions numbers) are gathered; rows are read in one or two
linear passes and no pairs of rows are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rtml.session import scratch_path

MAX_CLUSTERS = 10_000


def with_arrays(df: DataFrame, vec: str) -> DataFrame:
    """Vector or numeric array column as ``array<double>``."""
    if isinstance(df.schema[vec].dataType, T.ArrayType):
        return df.withColumn(vec, F.col(vec).cast("array<double>"))
    return df.withColumn(vec, vector_to_array(vec))


def with_vectors(df: DataFrame, vec: str) -> DataFrame:
    if isinstance(df.schema[vec].dataType, T.ArrayType):
        return df.withColumn(vec, array_to_vector(F.col(vec).cast("array<double>")))
    return df


def cluster_cells(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Long summary ``(cluster, dim, n, mean, var)``; one pass, partial aggregation in the JVM."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(vec))
    grouped = with_vectors(df, vec).groupBy(F.col(cluster).alias("cluster")) \
        .agg(summary.alias("s"))
    return grouped.select(
        "cluster", F.col("s.count").alias("n"),
        F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("mean"),
                                  vector_to_array("s.variance").alias("var")))) \
        .select("cluster", F.col("pos").alias("dim"), "n", F.col("col.mean").alias("mean"),
                F.col("col.var").alias("var"))


def centers_of(df: DataFrame, vec: str, cluster: str) -> tuple[list, np.ndarray, np.ndarray]:
    """Cluster labels, centers and sizes on the driver; refused beyond MAX_CLUSTERS clusters."""
    grouped = with_vectors(df, vec).groupBy(F.col(cluster).alias("cluster")) \
        .agg(Summarizer.metrics("count", "mean").summary(F.col(vec)).alias("s")) \
        .select("cluster", F.col("s.count").alias("n"), vector_to_array("s.mean").alias("c"))
    rows = grouped.orderBy("cluster").limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    return ([r.cluster for r in rows], np.array([r.c for r in rows], dtype=float),
            np.array([r.n for r in rows], dtype=float))


def _distance_block(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Euclidean distances rows x centers, dimension by dimension pairs avoided."""
    sq = (x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2.0 * x @ centers.T
    return np.sqrt(np.maximum(sq, 0.0))


def center_distances_per_row(df: DataFrame, vec: str, labels: list, centers: np.ndarray,
                             cluster: str | None = None) -> DataFrame:
    """Add ``nearest``, ``d_nearest``, ``d_second`` and, with a cluster column, ``d_own``."""
    index = {label: i for i, label in enumerate(labels)}
    known = np.asarray(centers, dtype=float)
    rows = max(1, 2_000_000 // max(len(known), 1))  # of a batch at a time: 16 MB of distances

    @F.pandas_udf("nearest int, d_nearest double, d_second double, d_own double")
    def measure(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for vectors, own in parts:
            if len(vectors) == 0:
                yield pd.DataFrame({"nearest": [], "d_nearest": [], "d_second": [], "d_own": []})
                continue
            places, out = own.map(index), []
            for i in range(0, len(vectors), rows):
                d = _distance_block(np.stack(vectors.iloc[i:i + rows].to_numpy()).astype(float),
                                    known)
                two = np.partition(d, 1, axis=1)[:, :2] if d.shape[1] > 1 else \
                    np.column_stack([d[:, 0], np.full(len(d), np.nan)])
                at = places.iloc[i:i + rows]
                mine = np.where(at.isna(), np.nan,
                                d[np.arange(len(d)), at.fillna(0).astype(int)])
                out.append(pd.DataFrame({"nearest": d.argmin(1).astype("int32"),
                                         "d_nearest": two[:, 0], "d_second": two[:, 1],
                                         "d_own": mine}))
            yield pd.concat(out, ignore_index=True)

    own = F.col(cluster) if cluster else F.lit(None).cast("int")
    names = F.array(*[F.lit(v) for v in labels])
    return with_arrays(df, vec).withColumn("_m", measure(F.col(vec), own)).select(
        *df.columns, F.element_at(names, F.col("_m.nearest") + 1).alias("nearest"),
        F.col("_m.d_nearest").alias("d_nearest"), F.nanvl("_m.d_second", F.lit(None))
        .alias("d_second"), F.nanvl("_m.d_own", F.lit(None)).alias("d_own"))


def inertia(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    labels, centers, _ = centers_of(df, vec, cluster)
    d = center_distances_per_row(df, vec, labels, centers)
    return d.agg(F.sum(F.col("d_nearest") * F.col("d_nearest")).alias("inertia"))


def calinski_harabasz(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Between over within dispersion, from the cluster summary alone."""
    cells = cluster_cells(df, vec, cluster)
    by_dim = Window.partitionBy("dim")
    grand = F.sum(F.col("n") * F.col("mean")).over(by_dim) / F.sum("n").over(by_dim)
    parts = cells.withColumn("_g", grand).agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("_g")) ** 2).alias("between"),
        F.sum(F.col("var") * (F.col("n") - 1)).alias("within"),
        F.count_distinct("cluster").alias("k"),
        F.sum(F.when(F.col("dim") == 0, F.col("n"))).alias("n"))
    score = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("n") - F.col("k")))
    return parts.select(score.alias("calinski_harabasz"))


def center_distances(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Distance of every pair of cluster centers, and both sizes; refused beyond MAX_CLUSTERS."""
    centers_of(df, vec, cluster)
    cells = cluster_cells(df, vec, cluster)
    a = cells.select(F.col("cluster").alias("cluster_a"), "dim", F.col("n").alias("size_a"),
                     F.col("mean").alias("_ma"))
    b = cells.select(F.col("cluster").alias("cluster_b"), F.col("dim").alias("_dim"),
                     F.col("n").alias("size_b"), F.col("mean").alias("_mb"))
    joined = a.join(b, (F.col("dim") == F.col("_dim")) & (F.col("cluster_a") < F.col("cluster_b")))
    return joined.groupBy("cluster_a", "cluster_b", "size_a", "size_b").agg(
        F.sqrt(F.sum((F.col("_ma") - F.col("_mb")) ** 2)).alias("distance"))


def davies_bouldin(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    labels, centers, _ = centers_of(df, vec, cluster)
    spread = center_distances_per_row(df, vec, labels, centers, cluster) \
        .groupBy(F.col(cluster).alias("cluster")).agg(F.avg("d_own").alias("spread"))
    found = {r.cluster: r.spread for r in spread.collect()}  # one row per cluster
    s = np.array([found[v] for v in labels])
    worst = np.zeros(len(labels))
    for i in range(0, len(labels), 256):
        d = _distance_block(centers[i:i + 256], centers)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = 0.0
        ratio = np.divide(s[i:i + 256, None] + s[None, :], d, out=np.zeros_like(d),
                          where=d > 1e-12)
        worst[i:i + 256] = ratio.max(axis=1)
    score = float(worst.mean()) if len(labels) > 1 else 0.0
    return df.sparkSession.createDataFrame([(score,)], "davies_bouldin double")


def stream_silhouette(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Sum of own-center distances over sum of second-nearest ones; null below two centers."""
    labels, centers, _ = centers_of(df, vec, cluster)
    d = center_distances_per_row(df, vec, labels, centers, cluster)
    score = F.try_divide(F.sum("d_own"), F.sum("d_second"))
    return d.agg((score if len(labels) > 1 else F.lit(None).cast("double"))
                 .alias("stream_silhouette"))


def silhouette_rows(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Squared-euclidean silhouette of every row, in linear time.

    The mean squared distance to a cluster follows from its size, mean and mean squared norm.
    """
    labels, centers, sizes = centers_of(df, vec, cluster)
    arrays = with_arrays(df, vec)
    norm = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)
    mean_norm = {r[0]: r[1] for r in arrays.groupBy(cluster).agg(F.avg(norm)).collect()}
    norms = np.array([mean_norm[v] for v in labels])
    index = {label: i for i, label in enumerate(labels)}

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vectors, own in parts:
            if len(vectors) == 0:
                yield pd.Series([], dtype=float)
                continue
            x = np.stack(vectors.to_numpy()).astype(float)
            at = own.map(index).astype(int).to_numpy()
            mean_sq = (x * x).sum(1)[:, None] + norms[None, :] - 2.0 * x @ centers.T
            row = np.arange(len(x))
            n_own = sizes[at]
            alone = n_own < 2
            inside = mean_sq[row, at] * n_own / np.where(alone, 1, n_own - 1)
            mean_sq[row, at] = np.inf
            outside = mean_sq.min(1)
            top = np.maximum(inside, outside)
            value = np.where(alone | (top <= 0), 0.0, (outside - inside) / np.where(top > 0, top, 1))
            yield pd.Series(value)

    return arrays.withColumn("silhouette", score(F.col(vec), F.col(cluster)))


def silhouette_by_cluster(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    rows = silhouette_rows(df, vec, cluster)
    return rows.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("avg_silhouette"),
        F.min("silhouette").alias("min_silhouette"), F.max("silhouette").alias("max_silhouette"))


def silhouette_score(df: DataFrame, vec: str, cluster: str) -> float:
    """Mean squared-euclidean silhouette by the built-in evaluator."""
    ready = with_vectors(df, vec).withColumn(cluster, F.col(cluster).cast("double"))
    return ClusteringEvaluator(predictionCol=cluster, featuresCol=vec).evaluate(ready)


def _packed_blocks(points: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """Rows dealt to blocks of about ``block_rows``, one row per block with flat arrays."""
    blocks = max(1, -(-points.count() // block_rows))
    packed = points.withColumn("_b", F.pmod(F.xxhash64("_r"), F.lit(blocks))).groupBy("_b").agg(
        F.collect_list(F.struct("_r", "_c", "_x")).alias("rows"))
    return packed.select("_b", F.col("rows._r").alias("r"), F.col("rows._c").alias("c"),
                         F.flatten("rows._x").alias("x")), blocks


def _pair_sums(k: int):
    """Sums of distances per cluster of the rows of two blocks to each other."""
    def arrays(batch, names, i):
        return [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names]

    def half(rows, x, onehot, other, same):
        parts = []
        for j in range(0, len(x), 256):
            gap = _distance_block(x[j:j + 256], other)
            if same:  # rounding leaves a row a little away from itself
                gap[np.arange(len(gap)), j + np.arange(len(gap))] = 0.0
            parts.append(gap @ onehot)
        sums = np.concatenate(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(sums.ravel()))],
            names=["_r", "sums"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r, c, x = arrays(batch, ("r", "c", "x"), i)
                r2, c2, x2 = arrays(batch, ("r2", "c2", "x2"), i)
                x, x2 = x.reshape(len(r), -1), x2.reshape(len(r2), -1)
                same = batch.column("_b")[i].as_py() == batch.column("_b2")[i].as_py()
                yield half(r, x, np.eye(k)[c2], x2, same)
                if not same:
                    yield half(r2, x2, np.eye(k)[c], x, False)
    return run


def silhouette_euclidean(df: DataFrame, vec: str, cluster: str, key: str,
                         block_rows: int = 2000) -> DataFrame:
    """Exact euclidean silhouette of every row.

    Rows are dealt to hashed blocks of about ``block_rows``; every pair of blocks is one piece of work
    for one task, whose sums of distances per row and cluster are added up afterwards. The work is
    quadratic by definition (the squared form above is linear), but no row passes the driver and a
    task holds two blocks. A row alone in its cluster, or without another cluster, has silhouette 0.
    """
    spark = df.sparkSession
    labels, _, sizes = centers_of(df, vec, cluster)
    place = F.element_at(F.create_map(*[x for i, v in enumerate(labels)
                                        for x in (F.lit(v), F.lit(i))]), F.col(cluster)) \
        if labels else F.lit(None).cast("int")
    path = scratch_path(spark, "silhouette")  # row numbers must not change between two reads
    with_arrays(df, vec).withColumns({"_r": F.monotonically_increasing_id(), "_c": place}) \
        .write.parquet(path)
    out = spark.read.parquet(path)
    blocks, n = _packed_blocks(out.select("_r", "_c", F.col(vec).alias("_x")), block_rows)
    path = scratch_path(spark, "blocks")
    blocks.write.parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    pairs = blocks.withColumn("_b2", F.explode(F.sequence(F.col("_b"), F.lit(n - 1).cast("long"))))
    other = blocks.select(*[F.col(c).alias(f"{c}2") for c in blocks.columns])
    sums = pairs.join(other.hint("shuffle_hash"), "_b2") \
        .mapInArrow(_pair_sums(len(labels)), "_r long, sums array<double>") \
        .groupBy("_r").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("_sums"))
    out = out.join(sums, "_r")
    counts = F.array(*[F.lit(float(s)) for s in sizes])
    own = F.get(counts, F.col("_c"))
    inside = F.get("_sums", F.col("_c")) / (own - 1)
    outside = F.array_min(F.filter(
        F.transform("_sums", lambda s, i: F.when(i != F.col("_c"), s / F.get(counts, i))),
        lambda m: m.isNotNull()))
    top = F.greatest(inside, outside)
    score = F.when((own < 2) | outside.isNull() | (top <= 0), 0.0) \
        .otherwise((outside - inside) / top)
    return out.withColumn("silhouette", score).drop("_sums", "_r", "_c")
