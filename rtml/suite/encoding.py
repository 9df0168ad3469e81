"""Dictionaries, encoders, scalers and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import encode as E
from rtml.operators.rolling import lag_features
from rtml.suite.base import query
from rtml.suite.roles import ERRORS_SQL, event_key, ordered_errors


def _dict(table: str, column: str) -> str:
    return (f"SELECT '{column}' AS feature, {column}::VARCHAR AS value, dense_rank() OVER "
            f"(ORDER BY {column} NULLS LAST) - 1 AS code FROM (SELECT DISTINCT {column} FROM {table})")


_ORDER_DICT = " UNION ALL ".join(_dict("orders", c) for c in ("o_orderpriority", "o_orderstatus",
                                                             "o_custkey"))


@query("label_dictionary", _ORDER_DICT)
def label_dictionary(t):
    return E.label_dictionary(t.orders, ["o_orderpriority", "o_orderstatus", "o_custkey"])


@query("label_encode_range_ranked", """SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderkey::VARCHAR)
 - 1 AS code FROM orders""")
def label_encode_range_ranked(t):
    """Near-unique text key: the dictionary is ranked over range partitions, then joined."""
    rows = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("code"))
    return E.label_encode(rows, ["code"], small_limit=0)


_KNOWN = "(SELECT o_orderpriority AS value, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code " \
         "FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'F' " \
         "AND o_orderpriority <> '5-LOW'))"


def _partial_dictionary(t):
    known = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
    return E.label_dictionary(known, ["o_orderpriority"])


@query("apply_dictionary_zero", f"""SELECT o_orderkey, coalesce(code, 0) AS o_orderpriority_code
 FROM orders LEFT JOIN {_KNOWN} ON o_orderpriority = value""")
def apply_dictionary_zero(t):
    return E.apply_dictionary(t.orders.select("o_orderkey", "o_orderpriority"),
                              _partial_dictionary(t), ["o_orderpriority"], "zero") \
        .drop("o_orderpriority")


@query("apply_dictionary_overflow", f"""SELECT o_orderkey, coalesce(code, (SELECT count(*) + 1 FROM
 {_KNOWN})) AS o_orderpriority_code, 0 AS o_orderstatus_code FROM orders LEFT JOIN {_KNOWN}
 ON o_orderpriority = value""", i="o_orderstatus_code")
def apply_dictionary_overflow(t):
    return E.apply_dictionary(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"),
                              _partial_dictionary(t), ["o_orderpriority", "o_orderstatus"],
                              "overflow").drop("o_orderpriority", "o_orderstatus")


@query("first_seen_codes", """SELECT feature, value, first_at, row_number() OVER (PARTITION BY feature
 ORDER BY first_at, value) - 1 AS code FROM (SELECT 'event_type' AS feature, event_type AS value,
 min(event_id) AS first_at FROM events GROUP BY event_type UNION ALL SELECT 'user_id',
 user_id::VARCHAR, min(event_id) FROM events GROUP BY user_id)""")
def first_seen_codes(t):
    return E.first_seen_dictionary(t.events, ["event_type", "user_id"], "event_id")


@query("encoder_mapping_export", """SELECT 'o_orderpriority' AS feature, value, code,
 max(code) OVER () + 1 AS next_id FROM (SELECT o_orderpriority AS value, dense_rank() OVER
 (ORDER BY o_orderpriority) - 1 AS code FROM (SELECT DISTINCT o_orderpriority FROM orders))""")
def encoder_mapping_export(t):
    exported = E.dictionary_as_map(E.label_dictionary(t.orders, ["o_orderpriority"]))
    return exported.select("feature", F.explode("mapping").alias("value", "code"), "next_id")


@query("standard_scale", """SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER ()
 AS value_scaled FROM events""", d="value_scaled")
def standard_scale(t):
    return E.standard_scale(t.events.select("event_id", "value"), ["value"]).drop("value")


@query("running_scale", """SELECT event_id, CASE WHEN n > 1 AND v > 1e-12 THEN (value - m) / sqrt(v)
 ELSE 0 END AS value_scaled FROM (SELECT event_id, value, count(*) OVER w AS n, avg(value) OVER w AS m,
 var_pop(value) OVER w AS v FROM events WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING))""",
       d="value_scaled")
def running_scale(t):
    return E.running_scale(t.events.select("event_id", "value"), ["value"], "event_id") \
        .drop("value")


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("one_hot", "SELECT event_id, " + ", ".join(
    f"(event_type = '{v}')::BIGINT AS event_type_{v}" for v in _TYPES) + " FROM events")
def one_hot(t):
    return E.one_hot(t.events.select("event_id", "event_type"), "event_type").drop("event_type")


@query("min_max", """SELECT event_id, (value - min(value) OVER ()) / (max(value) OVER () -
 min(value) OVER ()) AS value_norm FROM events""", d="value_norm")
def min_max(t):
    return E.min_max_scale(t.events.select("event_id", "value"), ["value"]).drop("value")


@query("class_weights", """SELECT l_returnflag, count(*) AS n, sum(count(*)) OVER () /
 (count(*) OVER () * count(*)) AS weight FROM lineitem GROUP BY l_returnflag""", d="weight")
def class_weights(t):
    return E.class_weights(t.lineitem, "l_returnflag")


@query("negative_positive_ratio", """SELECT count(*) FILTER (quality = 0) AS negatives,
 count(*) FILTER (quality = 1) AS positives,
 count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) AS ratio FROM labels""", d="ratio")
def negative_positive_ratio(t):
    return E.negative_positive_ratio(t.labels, "quality")


@query("drop_incomplete_rows", """SELECT event_id, value FROM events
 WHERE event_type <> 'error' AND value >= 5""", d="value", digits=2)
def drop_incomplete_rows(t):
    rows = t.events.select("event_id", F.when(F.col("value") >= 5, F.col("value")).alias("value"),
                           F.when(F.col("event_type") != "error", 1).alias("_known"))
    return E.drop_incomplete(rows, ["value", "_known"]).drop("_known")


@query("hashed_features")
def hashed_features(t):
    """Bucket numbers are Spark's own, so there is no SQL counterpart."""
    rows = event_key(t.events).select("event_id", "event_type", "user_id", "k")
    return E.hash_features(rows, ["event_type", "user_id", "k"], 256) \
        .select("event_id", F.col("hashed").cast("string").alias("hashed"))


@query("column_transformer")
def column_transformer(t):
    rows = event_key(t.events).withColumn("high", (F.col("value") > 50).cast("int"))
    from rtml.operators.sample import random_split
    parts = random_split(rows, "event_id")
    model = E.column_transformer(["value", "k"], ["high"], ["event_type"]) \
        .fit(parts.where("split = 'train'"))
    return model.transform(parts.where("split = 'test'")) \
        .select("event_id", F.col("features").cast("string").alias("features"))


@query("lag_season_features", f"""SELECT event_id, y, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2,
 lag(y, 3) OVER w AS lag_3, lag(y, 4) OVER w AS lag_4, lag(y, 5) OVER w AS lag_5,
 lag(y, 6) OVER w AS lag_6, lag(y, 7) OVER w AS lag_7, y - lag(y, 1) OVER w AS diff_1,
 lag(y, 7) OVER w AS season_lag_7, y - lag(y, 7) OVER w AS season_diff_7 FROM {ERRORS_SQL}
 WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
       d="y lag_1 lag_2 lag_3 lag_4 lag_5 lag_6 lag_7 diff_1 season_lag_7 season_diff_7", digits=2)
def lag_season_features(t):
    rows = ordered_errors(t.events).select("event_id", "event_type", "y")
    return lag_features(rows, ["event_type"], "event_id", "y").drop("event_type")
