"""Feature and target analysis: correlation, information, projections, dependence."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from rtml.operators.encode import drop_incomplete, min_max_scale
from rtml.operators.train import tree_cells


def normality_scores(df: DataFrame, columns: list[str]) -> DataFrame:
    """Jarque-Bera score per column from one pass of moments; smaller is closer to normal.

    A distributed stand-in for the single-machine normality test, so its values differ from it.
    """
    one = df.agg(*[F.struct(F.count(c).alias("n"), F.skewness(c).alias("s"),
                            F.kurtosis(c).alias("k")).alias(c) for c in columns])
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}.n").alias("n"),
                 F.col(f"{c}.s").alias("skewness"), F.col(f"{c}.k").alias("kurtosis"))
        for c in columns])).alias("p")).select("p.*")
    return rows.withColumn("jarque_bera", F.col("n") / 6.0 * (
        F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, long form, all pairs in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.col(f"`{a}|{b}`").alias("correlation")) for a, b in pairs])).alias("p")) \
        .select("p.*")


def target_correlation(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    one = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation"))
        for c in columns])).alias("p")).select("p.*").orderBy(F.col("correlation").desc(), "feature")


def equal_width_codes(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Replace numeric columns by their bin number 0..bins-1."""
    normed = min_max_scale(df, columns, suffix="_01")
    return normed.withColumns({c: F.least(F.floor(F.col(f"{c}_01") * bins), F.lit(bins - 1))
                               .cast("long") for c in columns}) \
        .drop(*[f"{c}_01" for c in columns])


def mutual_information(df: DataFrame, discrete: list[str], numeric: list[str], target: str,
                       bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) of every feature with a discrete target.

    The rows are read once; everything after that works on the joint counts.
    """
    coded = equal_width_codes(df, numeric, bins) if numeric else df
    long = coded.select(F.col(target).cast("string").alias("y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("x"))
        for c in [*discrete, *numeric]])).alias("p"))
    joint = long.groupBy("p.feature", "p.x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    x = joint.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    y = joint.groupBy("feature", "y").agg(F.sum("n").alias("ny"), )
    y = y.withColumn("t", F.sum("ny").over(Window.partitionBy("feature")))  # one row per class
    xs = x.select(F.col("feature").alias("fx"), F.col("x").alias("xv"), "nx")
    ys = y.select(F.col("feature").alias("fy"), F.col("y").alias("yv"), "ny", "t")
    both = joint.join(xs, (F.col("feature") == F.col("fx")) & F.col("x").eqNullSafe(F.col("xv"))) \
        .join(ys, (F.col("feature") == F.col("fy")) & F.col("y").eqNullSafe(F.col("yv")))
    return both.groupBy("feature").agg(F.sum(
        F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny"))))
        .alias("mutual_information"))


def mutual_information_numeric(df: DataFrame, discrete: list[str], numeric: list[str], target: str,
                               bins: int = 10) -> DataFrame:
    """As ``mutual_information`` for a continuous target, which is cut into equal-width bins too."""
    rows = df.where(F.col(target).isNotNull()).withColumn("_target", F.col(target))
    return mutual_information(equal_width_codes(rows, ["_target"], bins), discrete, numeric,
                              "_target", bins)


def joint_histogram(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Two-dimensional equal-width counts; sum over one axis for a marginal."""
    pair = df.select(F.col(x).alias("x_bin"), F.col(y).alias("y_bin"))
    coded = equal_width_codes(pair, ["x_bin", "y_bin"], bins)
    return coded.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))


def pair_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("correlation"))


def parallel_coordinates(df: DataFrame, columns: list[str], label: str, key: str,
                         fraction: float = 0.05, seed: int = 42) -> DataFrame:
    """Min-max scaled values of a hash sample, long form."""
    from rtml.operators.sample import hash_sample
    scaled = min_max_scale(df, columns, suffix="")
    return hash_sample(scaled, key, fraction, seed).select(
        key, label, F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
            for c in columns])).alias("p")).select(key, label, "p.feature", "p.value")


def radviz_points(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Point of each complete row between feature anchors placed evenly on the unit circle."""
    scaled = min_max_scale(drop_incomplete(df, columns), columns, suffix="_01")
    total = sum((F.col(f"{c}_01") for c in columns), F.lit(0.0))
    angle = [2 * math.pi * i / len(columns) for i in range(len(columns))]
    x = sum((F.col(f"{c}_01") * math.cos(a) for c, a in zip(columns, angle)), F.lit(0.0))
    y = sum((F.col(f"{c}_01") * math.sin(a) for c, a in zip(columns, angle)), F.lit(0.0))
    return scaled.select(*keep, F.coalesce(F.try_divide(x, total), F.lit(0.0)).alias("x"),
                         F.coalesce(F.try_divide(y, total), F.lit(0.0)).alias("y"))


def pca_model(df: DataFrame, columns: list[str], k: int = 2):
    """Fitted pipeline assemble, scale, project; the projection column is ``pca``."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=k, inputCol="_std", outputCol="pca")]).fit(df)


def pca_projection(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    out = pca_model(df, columns, 2).transform(df).withColumn("_p", vector_to_array("pca"))
    return out.select(*keep, F.col("_p")[0].alias("pc1"), F.col("_p")[1].alias("pc2"))


def explained_variance(df: DataFrame, columns: list[str], target: float = 0.9) -> DataFrame:
    """Variance share per component, its running sum, and whether it is needed for the target."""
    shares = pca_model(df, columns, len(columns)).stages[-1].explainedVariance.toArray()
    rows, total = [], 0.0
    for i, share in enumerate(shares):
        rows.append((i + 1, float(share), total + float(share), total < target))
        total += float(share)
    return df.sparkSession.createDataFrame(
        rows, "component int, variance double, cumulative double, needed boolean")


def feature_importances(model, columns: list[str], df: DataFrame, top: int = 20) -> DataFrame:
    """Importances of a fitted tree model relative to the largest, largest first."""
    values = model.featureImportances.toArray()
    best = float(values.max()) or 1.0
    ranked = sorted(zip(columns, values), key=lambda p: (-p[1], p[0]))[:top]
    return df.sparkSession.createDataFrame(
        [(c, float(v), float(v) / best) for c, v in ranked],
        "feature string, importance double, relative double")


def grid_values(df: DataFrame, column: str, points: int = 50, low: float = 0.05,
                high: float = 0.95) -> list[float]:
    """Even grid between two percentiles."""
    a, b = df.approxQuantile(column, [low, high], 0.001)
    return [a + (b - a) * i / (points - 1) for i in range(points)]


def partial_dependence(model, df: DataFrame, features: list[str], column: str,
                       grid: list[float], output: str = "prediction") -> DataFrame:
    """Average prediction with one feature set to each grid value.

    ``model`` assembles from the feature columns itself; pass a sampled ``df`` to bound the work.
    Of rows that no tree of a tree model tells apart one is copied, and counts for all.
    """
    others = [c for c in features if c != column]
    cells = tree_cells(model, df, [], free=column)
    rows = df.select(*others, F.lit(1).alias("_n")) if cells is None else cells
    copies = rows.select("*", F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias(column))
    scored = model.transform(copies)
    value = F.col(output) if output == "prediction" else vector_to_array(output)[1]
    return scored.groupBy(F.col(column).alias("grid")).agg(
        (F.sum(value * F.col("_n")) / F.sum("_n")).alias("average"))


def decision_surface(model, spark, x: tuple[str, float, float], y: tuple[str, float, float],
                     steps: int = 200, margin: float = 0.5) -> DataFrame:
    """Predictions over a steps x steps grid of two features, built and scored in parallel."""
    (xn, x0, x1), (yn, y0, y1) = x, y
    dx, dy = (x1 - x0 + 2 * margin) / (steps - 1), (y1 - y0 + 2 * margin) / (steps - 1)
    cells = spark.range(steps * steps).select(
        (F.lit(x0 - margin) + F.pmod("id", F.lit(steps)) * dx).alias(xn),
        (F.lit(y0 - margin) + F.floor(F.col("id") / steps) * dy).alias(yn))
    return model.transform(cells).select(xn, yn, "prediction")
