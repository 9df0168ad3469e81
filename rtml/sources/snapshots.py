"""Training snapshots and nested-count documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_snapshot(df: DataFrame, path: str, split: str | None = "split") -> None:
    """Snappy Parquet, one folder per split, so a read of one split touches only its files."""
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(split) if split else writer).parquet(path)


def read_snapshot(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """One split, or the union of all."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split).drop("split") if split else df


def counts_to_json(counts: DataFrame, cluster: str = "cluster",
                   max_values: int = 100_000) -> DataFrame:
    """Long counts to one JSON document ``{cluster: {feature: {value: n}}}`` per cluster.

    One row per cluster, so the whole export is never held in one place. A cluster with more than
    ``max_values`` counted values is refused: such counts stay a table.
    """
    longest = counts.groupBy(cluster).count().agg(F.max("count")).first()[0] or 0
    if longest > max_values:
        raise ValueError(f"{longest} values in one cluster; keep the counts as a table")
    values = counts.groupBy(cluster, "feature").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct("value", "n")))).alias("m"))
    features = values.groupBy(cluster).agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col("feature"), F.to_json("m"))))).alias("f"))
    body = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("f"), lambda e: F.concat(
        F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2),
        F.lit(":"), e["value"])), ","), F.lit("}"))
    return features.select(F.col(cluster).cast("string").alias("cluster"), F.concat(
        F.lit('{"'), F.col(cluster).cast("string"), F.lit('":'), body, F.lit("}"))
        .alias("document"))


def counts_from_json(documents: DataFrame, column: str = "document") -> DataFrame:
    """Back to long counts, cluster ids as integers."""
    shape = "map<string,map<string,map<string,bigint>>>"
    a = documents.select(F.explode(F.from_json(column, shape)).alias("cluster", "fs"))
    b = a.select("cluster", F.explode("fs").alias("feature", "vs"))
    return b.select(F.col("cluster").try_cast("long").alias("cluster"), "feature",
                    F.explode("vs").alias("value", "n"))
