"""Grouped profiles, sessions and rolling metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import profile as P, rolling as R, sessions as N
from rtml.sources.ingest import full_health_report, health_report, row_count, schema_report, \
    table_report
from rtml.sources.snapshots import counts_from_json, counts_to_json
from rtml.suite.base import query
from rtml.suite.roles import ERRORS_SQL, INTERACTIONS_SQL, as_interactions, ordered_errors

_FEATURES = ["event_type", "product_category", "browser", "device_type", "os"]


def _clustered(t):
    """Interactions with the device flattened; the cluster is the reported quantity."""
    from rtml.functions.scalars import json_struct
    from rtml.schemas import DEVICE
    rows = as_interactions(t.events).withColumn("_d", json_struct(F.col("device_info"), DEVICE))
    return rows.select("*", "_d.browser", "_d.device_type", "_d.os",
                       (F.col("session_event_sequence") % 4).alias("cluster")) \
        .drop("_d", "device_info", "location")


_CLUSTERED = f"(SELECT *, session_event_sequence % 4 AS cluster FROM {INTERACTIONS_SQL})"
_COUNTS = "(" + " UNION ALL ".join(
    f"SELECT cluster, '{f}' AS feature, coalesce({f}, 'None') AS value, count(*) AS n "
    f"FROM {_CLUSTERED} GROUP BY ALL" for f in _FEATURES) + ")"


@query("cluster_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label", i="label")
def cluster_counts(t):
    return P.cluster_counts(t.embeddings, "label")


@query("cluster_feature_counts", f"SELECT * FROM {_COUNTS}", i="cluster")
def cluster_feature_counts(t):
    return P.feature_value_counts(_clustered(t), "cluster", _FEATURES)


@query("cluster_feature_lookup", f"SELECT * FROM {_COUNTS} WHERE feature = 'os'", i="cluster")
def cluster_feature_lookup(t):
    return P.lookup_feature(P.feature_value_counts(_clustered(t), "cluster", _FEATURES), "os")


@query("cluster_top_values", f"""SELECT *, row_number() OVER (PARTITION BY cluster, feature ORDER BY n DESC,
 value) AS rank FROM {_COUNTS} QUALIFY rank <= 10""", i="cluster")
def cluster_top_values(t):
    counts = P.feature_value_counts(_clustered(t), "cluster", _FEATURES)
    return P.top_values(counts, ["cluster", "feature"])


_VALUES = [f"cat_{i}" for i in range(10)]


@query("cluster_value_pivot", "SELECT cluster, " + ", ".join(
    f"coalesce(sum(n) FILTER (value = '{v}'), 0) AS {v}" for v in _VALUES) +
    f" FROM {_COUNTS} WHERE feature = 'product_category' GROUP BY cluster",
       i="cluster " + " ".join(_VALUES))
def cluster_value_pivot(t):
    counts = P.feature_value_counts(_clustered(t), "cluster", ["product_category"])
    return P.cluster_matrix(counts, "cluster", _VALUES)


@query("nested_counts_json", f"SELECT * FROM {_COUNTS}", i="cluster")
def nested_counts_json(t):
    """Counts exported as nested JSON documents and read back."""
    counts = P.feature_value_counts(_clustered(t), "cluster", _FEATURES)
    return counts_from_json(counts_to_json(counts))


@query("cluster_profile", f"""SELECT cluster, count(*) AS size, avg(price) AS avg_price,
 avg(time_on_page_seconds) AS avg_time_on_page_seconds,
 round(count(*) * 100.0 / (SELECT count(*) FROM events), 1) AS pct FROM {_CLUSTERED}
 GROUP BY cluster""", d="avg_price avg_time_on_page_seconds pct", i="cluster")
def cluster_profile(t):
    return P.cluster_profile(_clustered(t), "cluster", ["price", "time_on_page_seconds"])


@query("class_balance", """SELECT count(*) AS n, count(*) FILTER (quality = 1) AS positives,
 count(*) FILTER (quality = 0) AS negatives, count(*) FILTER (quality = 1) * 100.0 / count(*)
 AS positive_pct, count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) AS imbalance_ratio
 FROM labels""", d="positive_pct imbalance_ratio")
def class_balance(t):
    return P.class_balance(t.labels, "quality")


@query("target_statistics", """SELECT avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std,
 min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders""", d="mean std min max", digits=2)
def target_statistics(t):
    return P.target_statistics(t.orders, "o_totalprice")


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS nulls, avg({c}) AS mean,
 stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q25,
 quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 FROM lineitem""" for c in _NUMERIC),
       d="mean std min max q25 q50 q75", digits=3)
def describe_numeric(t):
    return P.describe(t.lineitem, _NUMERIC)


@query("null_profile", f"""SELECT 'product_id' AS "column", 'string' AS type, count(product_id) AS non_null
 FROM {INTERACTIONS_SQL} UNION ALL SELECT 'price', 'double', count(price) FROM {INTERACTIONS_SQL}
 UNION ALL SELECT 'quantity', 'int', count(quantity) FROM {INTERACTIONS_SQL}""")
def null_profile(t):
    return P.null_profile(as_interactions(t.events).select("product_id", "price", "quantity"))


_LE = [1, 5, 10, 25, 50, 100, 250, 500]


@query("bucket_histogram", f"""SELECT event_type, le, count(*) FILTER (le IS NULL OR value <= le)
 AS cumulative FROM events CROSS JOIN (SELECT unnest({_LE} || [NULL])::DOUBLE AS le)
 GROUP BY event_type, le""", d="le")
def bucket_histogram(t):
    return P.bucket_histogram(t.events, "value", _LE, ["event_type"])


@query("target_bins", """SELECT b AS bin, lo + (b - 1) * (hi - lo) / 10 AS low,
 lo + b * (hi - lo) / 10 AS high, (SELECT count(*) FROM orders WHERE
 least(floor((o_totalprice - lo) / ((hi - lo) / 10)) + 1, 10) = b) AS n FROM
 (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), range(1, 11) r(b)""",
       d="low high", digits=2)
def target_bins(t):
    return P.equal_width_bins(t.orders, "o_totalprice", 10)


@query("balanced_bins", """SELECT 1 + (v > q[1])::INT + (v > q[2])::INT + (v > q[3])::INT AS bin,
 count(*) AS n, min(v) AS low, max(v) AS high FROM (SELECT o_totalprice AS v FROM orders),
 (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders) GROUP BY 1""",
       d="low high", i="bin", digits=2)
def balanced_bins(t):
    return P.balanced_bins(t.orders, "o_totalprice", 4)


@query("running_positive_ratio", """SELECT block, sum(n) OVER w AS messages, sum(p) OVER w AS positives,
 sum(p) OVER w / sum(n) OVER w AS ratio FROM (SELECT event_id // 100 AS block, count(*) AS n,
 count(*) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1)
 WINDOW w AS (ORDER BY block)""", d="ratio", i="messages positives")
def running_positive_ratio(t):
    return P.running_ratio(t.events, "event_id", F.col("event_type") == "purchase", 100)


_GAP = 6 * 3600
_SESSIONS = f"""(SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM
 (SELECT event_id, user_id, event_type, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
 <= INTERVAL {_GAP} SECONDS THEN 0 ELSE 1 END AS new FROM events))"""


def _sessions(t, hot_rows=N.HOT_USER_ROWS):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return N.session_ids(rows, "user_id", "ts", _GAP, hot_rows)


@query("session_ids", f"SELECT event_id, user_id, session_no FROM {_SESSIONS}", i="session_no")
def session_ids(t):
    return _sessions(t).select("event_id", "user_id", "session_no")


@query("session_ids_chunked", f"SELECT event_id, user_id, session_no FROM {_SESSIONS}", i="session_no")
def session_ids_chunked(t):
    """The same with every user cut into time chunks, as for hot users."""
    return _sessions(t, None).select("event_id", "user_id", "session_no")


@query("session_sequence", f"""SELECT event_id, session_no, row_number() OVER (PARTITION BY user_id,
 session_no ORDER BY ts) AS sequence FROM {_SESSIONS}""", i="session_no")
def session_sequence(t):
    numbered = N.session_sequence(_sessions(t), ["user_id", "session_no"], "ts")
    return numbered.select("event_id", "session_no", "sequence")


@query("session_windows", f"""SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started,
 count(*) AS events FROM {_SESSIONS} GROUP BY user_id, session_no""")
def session_windows(t):
    found = N.session_windows(t.events, "user_id", "ts", _GAP)
    return found.select("user_id", F.date_format("started", "yyyy-MM-dd HH:mm:ss")
                        .alias("started"), "events")


@query("session_funnel", f"""SELECT count(v) AS sessions_view, count(*) FILTER (c >= v) AS sessions_click,
 count(*) FILTER (c >= v AND p >= c) AS sessions_purchase,
 count(*) FILTER (c >= v) / count(v) AS rate_view_click,
 count(*) FILTER (c >= v AND p >= c) / count(*) FILTER (c >= v) AS rate_click_purchase FROM
 (SELECT min(ts) FILTER (event_type = 'view') AS v, min(ts) FILTER (event_type = 'click') AS c,
 min(ts) FILTER (event_type = 'purchase') AS p FROM {_SESSIONS} GROUP BY user_id, session_no)""",
       d="rate_view_click rate_click_purchase")
def session_funnel(t):
    return N.funnel(_sessions(t), ["user_id", "session_no"], "event_type", "ts",
                    ["view", "click", "purchase"])


@query("active_sessions", f"""SELECT count(*) AS sessions, count(*) FILTER (newest - ended < INTERVAL
 15 MINUTES) AS active_sessions FROM (SELECT max(ts) AS ended FROM {_SESSIONS} GROUP BY user_id,
 session_no), (SELECT max(ts) AS newest FROM events)""")
def active_sessions(t):
    return N.active_sessions(_sessions(t), ["user_id", "session_no"], "ts")


@query("running_accuracy_every_100", f"""SELECT event_id, rows_so_far, running_mae, running_hit FROM
 (SELECT event_id, count(*) OVER w AS rows_so_far, avg(abs(y - yhat)) OVER w AS running_mae,
 avg((yhat >= 50)::INT = hit) OVER w AS running_hit FROM
 (SELECT event_id, y, yhat, hit FROM {ERRORS_SQL})
 WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)) WHERE event_id % 100 = 0"""
       .replace("avg((yhat >= 50)::INT = hit)", "avg(((yhat >= 50)::INT = hit)::INT)"),
       d="running_mae running_hit")
def running_accuracy_every_100(t):
    rows = ordered_errors(t.events).select("event_id", "y", "yhat", "hit")
    right = ((F.col("yhat") >= 50).cast("int") == F.col("hit")).cast("int")
    run = R.running_means(rows, [], "event_id", {
        "running_mae": F.abs(F.col("y") - F.col("yhat")), "running_hit": right})
    return R.every(run, "event_id", 100).select("event_id", "rows_so_far", "running_mae",
                                                "running_hit")


@query("rolling_mae_1000", f"""SELECT event_id, avg(abs(y - yhat)) OVER w AS mae,
 sqrt(avg((y - yhat) * (y - yhat)) OVER w) AS rmse FROM {ERRORS_SQL} WINDOW w AS
 (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
       d="mae rmse", digits=5)
def rolling_mae_1000(t):
    rows = ordered_errors(t.events).select("event_id", "event_type", "y", "yhat")
    e = F.col("y") - F.col("yhat")
    out = R.rolling_means(rows, ["event_type"], "event_id", {"mae": F.abs(e), "_mse": e * e}, 1000)
    return out.select("event_id", "mae", F.sqrt("_mse").alias("rmse"))


@query("time_rolling_mae_5m", f"""SELECT event_id, count(*) OVER w AS rows_in_frame,
 avg(abs(y - yhat)) OVER w AS mae FROM {ERRORS_SQL} WINDOW w AS (ORDER BY ts RANGE BETWEEN
 INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)""", d="mae", digits=5)
def time_rolling_mae_5m(t):
    rows = ordered_errors(t.events).select("event_id", "ts", "y", "yhat")
    out = R.time_rolling_means(rows, [], "ts", {"mae": F.abs(F.col("y") - F.col("yhat"))}, 300)
    return out.select("event_id", "rows_in_frame", "mae")


@query("block_rolling_auc", f"""SELECT e AS at_row, sum(hit) AS positives, count(*) - sum(hit) AS negatives,
 sum((1 - hit) * (above + tied / 2.0)) / (sum(hit) * (count(*) - sum(hit))) AS auc FROM
 (SELECT e, hit, sum(hit) OVER (PARTITION BY e ORDER BY score DESC) - sum(hit) OVER (PARTITION BY e,
 score) AS above, sum(hit) OVER (PARTITION BY e, score) AS tied FROM
 (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM {ERRORS_SQL}) r
 JOIN (SELECT unnest(range(1000, (SELECT count(*) FROM events) + 1, 1000)) AS e) p
 ON rn <= e AND rn > e - 5000) GROUP BY e""", d="auc", i="at_row positives negatives")
def block_rolling_auc(t):
    rows = ordered_errors(t.events).select("event_id", "hit", "score")
    return R.rolling_auc(rows, [], "event_id", "hit", "score", rows=5000, step=1000)


@query("table_schema_report", """SELECT row_number() OVER () - 1 AS position, column_name AS "column",
 CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type, true AS nullable
 FROM (DESCRIBE lineitem)""", i="position")
def table_schema_report(t):
    return schema_report(t.lineitem)


@query("table_row_count", "SELECT count(*) AS row_count FROM documents")
def table_row_count(t):
    return row_count(t.documents)


@query("table_health_report", "SELECT 1 AS files, count(*) AS rows, 11 AS columns FROM lineitem",
       i="files columns")
def table_health_report(t):
    return health_report(t.lineitem)


@query("table_report", """SELECT row_number() OVER () - 1 AS position, column_name AS "column",
 CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type, true AS nullable,
 'orders.parquet' AS file, (SELECT count(*) FROM orders) AS row_count FROM (DESCRIBE orders)""",
       i="position")
def table_report_of_orders(t):
    """Schema with the table's path (here its last part) and number of rows."""
    return table_report(t.spark, f"{t.folder}/orders.parquet") \
        .withColumn("file", F.substring_index("path", "/", -1)).drop("path")


@query("table_health_full", """SELECT NULL::BIGINT AS version, 1 AS files, count(*) AS rows, 4 AS columns,
 'o_orderkey: bigint;o_custkey: bigint;o_orderstatus: string;o_orderpriority: string' AS column_types,
 (SELECT string_agg(j, ';' ORDER BY o_orderkey) FROM (SELECT o_orderkey, to_json({'o_orderkey':
 o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, 'o_orderpriority':
 o_orderpriority})::VARCHAR AS j FROM orders ORDER BY o_orderkey LIMIT 3)) AS first_rows
 FROM orders""", i="files columns")
def table_health_full(t):
    """Version, files, rows, column types and the first three rows (the report's own limit)."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return full_health_report(rows, ["o_orderkey"]).withColumns(
        {c: F.concat_ws(";", c) for c in ("column_types", "first_rows")})


_METRICS = dict(zip(P.BUCKETS, ["amount", "share", "share", "share", "amount", "amount", "amount", "share",
                                "amount"]))
_EDGES = " UNION ALL ".join(f"SELECT '{m}' AS metric, '{_METRICS[m]}' AS kind, unnest({b}::DOUBLE[] || [NULL]) AS le"
                            for m, b in P.BUCKETS.items())


@query("service_histograms", f"""SELECT event_type, metric, le, count(*) FILTER (v IS NOT NULL AND (le IS NULL
 OR v <= le)) AS cumulative, count(v) AS n, coalesce(sum(v), 0) AS total FROM ({_EDGES}) JOIN
 (SELECT event_type, 'amount' AS kind, value AS v FROM events UNION ALL SELECT event_type, 'share',
 CASE WHEN event_id % 9 > 0 THEN value / 100 END FROM events) USING (kind)
 GROUP BY event_type, metric, le""", d="total", digits=3)
def service_histograms(t):
    """All nine fixed bucket lists from one pass over the events."""
    rows = t.events.select("event_type", F.col("value").alias("amount"),
                           F.when(F.col("event_id") % 9 > 0, F.col("value") / 100).alias("share"))
    return P.service_histograms(rows, _METRICS, ["event_type"])
