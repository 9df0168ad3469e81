"""Connected components of a graph of nodes and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtml.session import scratch_path


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected(nodes: DataFrame, links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every node; ``component`` is the smallest node that links lead to.

    ``nodes`` has one column of longs, ``links`` the columns ``a`` and ``b``. In every round a node
    takes the smallest label among its own, its neighbours' and that of the node its label names;
    the last step doubles the reach of labels, so rounds follow the logarithm of the longest path
    rather than its length. Each round is two joins and two aggregations, written to the shared
    folder. Links to unknown nodes count for nothing.
    """
    nodes = nodes.toDF("node").distinct()
    labels = _kept(nodes.withColumn("label", F.col("node")), "labels")
    both = _kept(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b")
                 .where("a <> b").distinct(), "links")
    for _ in range(max_rounds):
        named = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        lowest = both.join(named, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("near").alias("near"))
        stepped = labels.join(lowest, "node", "left").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        stepped = _kept(stepped, "stepped")
        further = stepped.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = _kept(stepped.join(further, "label", "left").select(
            "node", F.least("label", "far").alias("label"),
            (F.least("label", "far") < F.col("was")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.drop("moved")
    raise RuntimeError("components did not settle")
