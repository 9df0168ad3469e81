"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import sample as P
from rtml.suite.base import query


def _unit(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || ':{seed}'), 1, 13))::BIGINT / 4503599627370496.0)"


_U = _unit("event_id")


@query("hash_sample", f"SELECT event_id, event_type FROM events WHERE {_U} < 0.1")
def hash_sample(t):
    return P.hash_sample(t.events, "event_id", 0.1).select("event_id", "event_type")


_LINE = "(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR)"


@query("percent_sample", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {_unit(_LINE)} < 0.1")
def percent_sample(t):
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return P.percent_sample(t.lineitem, 10.0, key=key).select("l_orderkey", "l_linenumber")


@query("random_rows", """SELECT least(100, count(*)) AS rows, least(100, count(*)) AS distinct_rows,
 least(100, count(*)) AS known_rows FROM orders""")
def random_rows(t):
    """Which rows come is not fixed: their number, no repetition, and all from the table."""
    rows = P.random_rows(t.orders, 100, seed=7).select("o_orderkey")
    known = rows.join(t.orders.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left")
    return known.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_distinct("o_orderkey").alias("distinct_rows"),
                     F.count("known").alias("known_rows"))


@query("row_cap", """SELECT least(1000, count(*)) AS rows, true AS in_range FROM events""")
def row_cap(t):
    """A row cap after encoding: codes stay in the range of the whole table's dictionaries."""
    from rtml.plans.features import feature_dictionary, training_features
    from rtml.suite.roles import as_interactions
    name, rows = "e_commerce_customer_interactions", as_interactions(t.events)
    capped = training_features(rows, name, max_rows=1000)
    sizes = {r.feature: r.n for r in feature_dictionary(rows, name).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    good = F.lit(True)
    for c, n in sizes.items():
        good = good & (F.col(c) >= 0) & (F.col(c) < n)
    return capped.agg(F.count(F.lit(1)).alias("rows"), F.every(good).alias("in_range"))


_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_U}, event_id) AS rn,
 count(*) OVER (PARTITION BY event_type) AS n FROM events)"""


@query("stratified_split", f"""SELECT event_id, event_type, CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test'
 ELSE 'train' END AS split FROM {_RANKED}""")
def stratified_split(t):
    return P.stratified_split(t.events.select("event_id", "event_type"), "event_type", "event_id")


@query("stratified_split_counts", f"""SELECT event_type, CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test'
 ELSE 'train' END AS split, count(*) AS rows FROM {_RANKED} GROUP BY 1, 2""")
def stratified_split_counts(t):
    parts = P.stratified_split(t.events.select("event_id", "event_type"), "event_type", "event_id")
    return parts.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("rows"))


@query("random_split", f"""SELECT CASE WHEN {_U} < 0.2 THEN 'test' ELSE 'train' END AS split,
 count(*) AS rows, sum(event_id) AS id_sum FROM events GROUP BY 1""", i="id_sum")
def random_split(t):
    parts = P.random_split(t.events.select("event_id"), "event_id")
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                      F.sum("event_id").alias("id_sum"))


@query("stratified_subsample", f"""SELECT event_id, event_type FROM {_RANKED}
 WHERE rn <= floor(n * 500 / (SELECT count(*) FROM events) + 0.5)""")
def stratified_subsample(t):
    return P.stratified_subsample(t.events.select("event_id", "event_type"), "event_type",
                                  "event_id", 500)


@query("kfold_counts", f"""SELECT event_type, (rn - 1) % 5 AS fold, count(*) AS rows,
 sum(event_id) AS id_sum FROM {_RANKED} GROUP BY 1, 2""", i="id_sum")
def kfold_counts(t):
    parts = P.folds(t.events.select("event_id", "event_type"), "event_id", 5, "event_type")
    return parts.groupBy("event_type", "fold").agg(F.count(F.lit(1)).alias("rows"),
                                                   F.sum("event_id").alias("id_sum"))


@query("nested_train_sizes", f"""SELECT f AS train_fraction, count(*) AS rows, sum(event_id) AS id_sum FROM
 (SELECT event_id, row_number() OVER (ORDER BY {_U}, event_id) AS rn, count(*) OVER () AS n FROM events)
 JOIN (VALUES (0.1::DOUBLE), (0.325::DOUBLE), (0.55::DOUBLE), (0.775::DOUBLE), (1.0::DOUBLE)) s(f)
 ON rn <= floor(n * f + 0.5) GROUP BY 1""", d="train_fraction", i="id_sum")
def nested_train_sizes(t):
    sized = P.nested_sizes(t.events.select("event_id"), "event_id", P.train_fractions())
    return sized.groupBy("train_fraction").agg(F.count(F.lit(1)).alias("rows"),
                                               F.sum("event_id").alias("id_sum"))


@query("undersample_balance", f"""SELECT quality, count(*) AS rows, sum(doc_id) AS id_sum FROM (SELECT *,
 0.5 / (count(*) OVER (PARTITION BY quality) / count(*) OVER ()) AS r FROM labels)
 WHERE {_unit("doc_id")} < r / (SELECT max(0.5 / (c / t)) FROM (SELECT count(*) AS c,
 sum(count(*)) OVER () AS t FROM labels GROUP BY quality)) GROUP BY 1""", i="quality id_sum")
def undersample_balance(t):
    kept = P.undersample(t.labels.select("doc_id", "quality"), "quality", "doc_id",
                         {0: 0.5, 1: 0.5})
    return kept.groupBy("quality").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("doc_id").alias("id_sum"))


@query("union_splits", """SELECT count(*) AS rows, sum(event_id) AS id_sum,
 count(DISTINCT event_id) AS distinct_ids FROM events""", i="id_sum")
def union_splits(t):
    parts = P.random_split(t.events.select("event_id", "value"), "event_id")
    whole = P.union_splits(parts.where("split = 'train'"), parts.where("split = 'test'"))
    return whole.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"),
                     F.count_distinct("event_id").alias("distinct_ids"))


@query("distinct_queries", """SELECT DISTINCT text FROM conversations WHERE role = 'user'
 AND text IS NOT NULL AND length(text) > 2""")
def distinct_queries(t):
    return P.distinct_queries(t.conversations.where("role = 'user'"), "text")


@query("search_projection", """SELECT conv_id, turn, text FROM conversations WHERE role = 'user'
 AND trim(text) <> ''""")
def search_projection(t):
    return P.search_projection(t.conversations.where("role = 'user'"), "text",
                               ["conv_id", "turn", "text"])
