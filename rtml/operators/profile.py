"""Grouped profiles: cluster counters, class balance, histograms, descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rtml.operators.encode import category_values
from rtml.plans.prefix import exact_quantiles, exact_quantiles_of, running_totals, with_chunk

# Bucket bounds of the service histograms, in seconds or bytes.
BUCKETS = {
    "training_duration_seconds": [10, 30, 60, 120, 300, 600, 1200, 1800, 3600],
    "prediction_duration_seconds": [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5],
    "model_load_duration_seconds": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0],
    "mlflow_operation_duration_seconds": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0],
    "sql_query_duration_seconds": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0],
    "sql_rows_returned": [0, 1, 10, 50, 100, 500, 1000, 5000, 10000],
    "visualization_duration_seconds": [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0],
    "send_duration_seconds": [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0],
    "message_size_bytes": [100, 500, 1000, 5000, 10000, 50000],
}

# Identifiers and continuous columns that are never counted per cluster.
NOT_COUNTED = ["event_id", "customer_id", "session_id", "timestamp", "price", "page_url",
               "search_query", "lat", "lon"]


def group_summary(df: DataFrame, by: list[str], aggs: dict[str, Column],
                  order: list[Column | str] | None = None, top: int | None = None) -> DataFrame:
    """Group, aggregate, order, keep the first ``top`` (planned as a top-n, not a full sort)."""
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    if order:
        out = out.orderBy(*order)
    return out.limit(top) if top else out


def cluster_counts(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def feature_value_counts(df: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """Long counts ``(cluster, feature, value, n)`` of several features in one pass."""
    long = df.select(cluster, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"),
                 F.coalesce(F.col(f).cast("string"), F.lit("None")).alias("value"))
        for f in features])).alias("p"))
    return long.groupBy(cluster, "p.feature", "p.value").agg(F.count(F.lit(1)).alias("n"))


def countable_features(df: DataFrame, cluster: str) -> list[str]:
    return [c for c in df.columns if c not in NOT_COUNTED and c != cluster]


def lookup_feature(counts: DataFrame, feature: str) -> DataFrame:
    """Counts of one feature across clusters, from the long counts."""
    return counts.where(F.col("feature") == feature)


def top_values(counts: DataFrame, by: list[str], value: str = "value", n: str = "n",
               k: int = 10) -> DataFrame:
    """The k most frequent values per group; the rank limit is applied before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.col(n).desc(), F.col(value).asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cluster_matrix(counts: DataFrame, cluster: str, values: list, value: str = "value",
                   n: str = "n") -> DataFrame:
    """Cluster by value counts, zero-filled, for a given value list."""
    return counts.groupBy(cluster).agg(*[
        F.coalesce(F.sum(F.when(F.col(value) == F.lit(v), F.col(n))), F.lit(0))
        .cast("long").alias(str(v)) for v in values])


def cluster_profile(df: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    grouped = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"),
                                      *[F.avg(f).alias(f"avg_{f}") for f in features])
    return grouped.withColumn("pct", F.round(F.col("size") * 100.0 / total, 1))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Counts, percent of positives and negatives per positive, one row."""
    pos, n = F.count_if(F.col(label) == 1), F.count(label)
    return df.agg(n.alias("n"), pos.alias("positives"), (n - pos).alias("negatives"),
                  (F.try_divide(pos, n) * 100.0).alias("positive_pct"),
                  F.try_divide((n - pos), pos).alias("imbalance_ratio"))


def target_statistics(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
                  F.min(target).cast("double").alias("min"),
                  F.max(target).cast("double").alias("max"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, nulls, mean, std, min, exact quartiles, max per column, one row each."""
    n = F.count(F.lit(1))
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(n.alias("rows"), *[
        F.struct(*[f(F.col(c).cast("double")).alias(s) for s, f in stats.items()]).alias(c)
        for c in columns])
    basic = one.select("rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns])).alias("p")) \
        .select("p.column", F.col("p.s.count").alias("count"),
                (F.col("rows") - F.col("p.s.count")).alias("nulls"),
                *[F.col(f"p.s.{s}").alias(s) for s in ("mean", "std", "min", "max")])
    quartiles = exact_quantiles_of(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.join(quartiles, "column", "left")


def null_profile(df: DataFrame) -> DataFrame:
    """Non-null count and type of every column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f.name).alias("non_null")) for f in df.schema])).alias("p")).select("p.*")


def bucket_histogram(df: DataFrame, value: str, bounds: list[float],
                     by: list[str] | None = None) -> DataFrame:
    """Cumulative ``le`` buckets with a final +Inf bucket (``le`` null), per group.

    Rows are counted once, in their own bucket; the running sum is over the fixed bucket list.
    """
    by = by or []
    edges = [*[float(b) for b in bounds], float("inf")]
    counts = df.groupBy(*by).agg(*[
        F.count_if(F.col(value) <= F.lit(e)).alias(f"b{i}") for i, e in enumerate(edges)])
    return counts.select(*by, F.explode(F.array(*[
        F.struct(F.lit(e if e != float("inf") else None).cast("double").alias("le"),
                 F.col(f"b{i}").alias("cumulative")) for i, e in enumerate(edges)])).alias("p")) \
        .select(*by, "p.le", "p.cumulative")


def service_histograms(df: DataFrame, values: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Cumulative buckets, number and sum of several service metrics from one pass.

    ``values`` maps metric names of ``BUCKETS`` to columns. One row per group, metric and bucket; the
    last bucket of a metric has ``le`` null and holds all its values. Nulls are no values.
    """
    by = by or []
    aggs, parts = [], []
    for i, (metric, column) in enumerate(values.items()):
        v = F.col(column).cast("double")
        edges = [*[float(b) for b in BUCKETS[metric]], None]
        aggs += [F.count(v).alias(f"n{i}"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s{i}"), *[
            F.count_if(v <= e).alias(f"b{i}_{j}") for j, e in enumerate(edges) if e is not None]]
        parts += [F.struct(
            F.lit(metric).alias("metric"), F.lit(e).cast("double").alias("le"),
            F.col(f"n{i}" if e is None else f"b{i}_{j}").alias("cumulative"),
            F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("total")) for j, e in enumerate(edges)]
    return df.groupBy(*by).agg(*aggs).select(*by, F.explode(F.array(*parts)).alias("p")) \
        .select(*by, "p.*")


def equal_width_bins(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Bin number 1..bins, its edges and count; every bin between min and max is listed."""
    span = df.agg(F.struct(F.min(value).cast("double").alias("lo"),
                           F.max(value).cast("double").alias("hi")).alias("s"))
    placed = df.where(F.col(value).isNotNull()).withColumn("_s", span.scalar())
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    number = F.when(width == 0, 1).otherwise(
        F.least(F.floor((F.col(value) - F.col("_s.lo")) / width) + 1, F.lit(bins)))
    found = placed.groupBy(number.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = span.select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"), "s")
    step = (F.col("s.hi") - F.col("s.lo")) / bins
    return frame.join(found, "bin", "left").select(
        "bin", (F.col("s.lo") + (F.col("bin") - 1) * step).alias("low"),
        (F.col("s.lo") + F.col("bin") * step).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def balanced_bins(df: DataFrame, value: str, bins: int = 4) -> DataFrame:
    """Bins of about equal counts, cut at exact quantiles; upper edge included."""
    names = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(df, value, names)
    placed = df.where(F.col(value).isNotNull()) \
        .withColumn("_q", edges.select(F.struct(*names)).scalar())
    number = F.lit(1)
    for q in names:
        number = number + (F.col(value) > F.col(f"_q.{q}")).cast("int")
    return placed.groupBy(number.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).cast("double").alias("low"),
        F.max(value).cast("double").alias("high"))


def running_ratio(df: DataFrame, order: str, positive: Column, block: int = 100) -> DataFrame:
    """Share of positives so far, reported once per ``block`` rows of a dense order column.

    Blocks are counted first; the running sum then goes over blocks in chunks.
    """
    number = F.floor(F.col(order) / block).cast("long")
    blocks = df.groupBy(number.alias("block")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(positive).alias("_p"))
    run = running_totals(with_chunk(blocks, "block"), [], ["block"],
                         {"messages": F.col("_n"), "positives": F.col("_p")})
    return run.select("block", "messages", "positives",
                      (F.col("positives") / F.col("messages")).alias("ratio"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def value_list(df: DataFrame, column: str, limit: int = 1000) -> list:
    return category_values(df, column, limit)
