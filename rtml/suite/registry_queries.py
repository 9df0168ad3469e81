"""Run registry: line items grouped by supplier stand for runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import registry as K, rolling as R
from rtml.suite.base import query
from rtml.suite.roles import ordered_errors

_RUNS = """(SELECT l_suppkey AS run_id, l_suppkey - 1 AS parent_run_id, 'model_' || (l_suppkey % 3) AS name,
 CASE l_suppkey % 4 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'FAILED' ELSE 'FINISHED' END AS status,
 max(l_shipdate) - INTERVAL (l_suppkey) HOURS AS start_time,
 max(l_shipdate) - INTERVAL (l_suppkey) MINUTES AS updated_at, l_suppkey % 5 <> 0 AS has_artifact,
 CASE WHEN l_suppkey % 7 <> 0 THEN round(avg(l_discount), 8) END AS fbeta_score,
 round(avg(l_tax), 8) AS mae, count(*) AS train_rows, count(*) FILTER (l_tax > 0.04) AS test_rows
 FROM lineitem GROUP BY l_suppkey)"""


def _runs(t):
    s = F.col("l_suppkey")
    g = t.lineitem.groupBy("l_suppkey").agg(
        F.max("l_shipdate").alias("_last"), F.round(F.avg("l_discount"), 8).alias("_d"),
        F.round(F.avg("l_tax"), 8).alias("mae"), F.count(F.lit(1)).alias("train_rows"),
        F.count_if(F.col("l_tax") > 0.04).alias("test_rows"))
    return g.select(
        s.alias("run_id"), (s - 1).alias("parent_run_id"),
        F.concat(F.lit("model_"), (s % 3).cast("string")).alias("name"),
        F.when(s % 4 == 0, "RUNNING").when(s % 4 == 1, "FAILED").otherwise("FINISHED")
        .alias("status"),
        (F.col("_last") - F.make_dt_interval(hours=s.cast("int"))).alias("start_time"),
        (F.col("_last") - F.make_dt_interval(mins=s.cast("int"))).alias("updated_at"),
        (s % 5 != 0).alias("has_artifact"), F.when(s % 7 != 0, F.col("_d")).alias("fbeta_score"),
        "mae", "train_rows", "test_rows")


_FIRST = "ORDER BY {m} DESC NULLS LAST, start_time DESC, run_id"


@query("best_run", f"""SELECT name, run_id, fbeta_score FROM {_RUNS} WHERE status = 'FINISHED'
 AND has_artifact QUALIFY row_number() OVER (PARTITION BY name {_FIRST.format(m='fbeta_score')}) = 1""",
       d="fbeta_score")
def best_run(t):
    return K.best_run(_runs(t), None, "fbeta_score", True, by=["name"]) \
        .select("name", "run_id", "fbeta_score")


@query("best_run_fallback", f"""SELECT run_id, name FROM {_RUNS} WHERE status = 'FINISHED' AND has_artifact
 AND name = 'model_1' ORDER BY start_time DESC, run_id LIMIT 1""")
def best_run_fallback(t):
    """The metric is not logged at all, so the newest run wins."""
    return K.best_run(_runs(t), "model_1", "MAE_missing", False).select("run_id", "name")


@query("run_leaderboard", f"""SELECT run_id, fbeta_score, row_number() OVER ({_FIRST.format(m='fbeta_score')})
 AS place, row_number() OVER ({_FIRST.format(m='fbeta_score')}) = 1 AS is_best,
 train_rows + test_rows AS total_rows FROM {_RUNS}""", d="fbeta_score")
def run_leaderboard(t):
    board = K.run_leaderboard(_runs(t), "fbeta_score", True, rows=("train_rows", "test_rows"))
    return board.select("run_id", "fbeta_score", "place", "is_best", "total_rows")


@query("run_metrics_long", f"""SELECT run_id, kind, key, round(value, 4) AS value FROM (SELECT run_id,
 'metrics' AS kind, 'fbeta' AS key, fbeta_score AS value FROM {_RUNS} UNION ALL SELECT run_id, 'metrics',
 'mae', mae FROM {_RUNS} UNION ALL SELECT run_id, 'params', 'rows', train_rows FROM {_RUNS})
 WHERE value IS NOT NULL""", d="value", digits=4)
def run_metrics_long(t):
    wide = _runs(t).select("run_id", F.col("fbeta_score").alias("metrics.fbeta"),
                           F.col("mae").alias("metrics.mae"),
                           F.col("train_rows").alias("params.rows"))
    return K.to_long(wide).withColumn("value", F.col("value").cast("double"))


@query("live_or_best", f"""SELECT name, run_id, source FROM (SELECT *, CASE WHEN live THEN 'live' ELSE 'best'
 END AS source FROM (SELECT *, status = 'RUNNING' AND updated_at >= newest - INTERVAL 1 HOUR AS live
 FROM {_RUNS}, (SELECT max(updated_at) AS newest FROM {_RUNS})) WHERE live OR
 (status = 'FINISHED' AND has_artifact)) QUALIFY row_number() OVER (PARTITION BY name ORDER BY
 NOT live, CASE WHEN NOT live THEN fbeta_score END DESC NULLS LAST, start_time DESC, run_id) = 1""")
def live_or_best(t):
    runs = _runs(t)
    newest = runs.agg(F.max("updated_at")).scalar()
    chosen = K.live_or_best(runs.withColumn("_now", newest), "fbeta_score", True, F.col("_now"),
                            by=["name"])
    return chosen.select("name", "run_id", "source")


@query("baseline_delta", f"""SELECT r.run_id, r.mae, b.mae AS baseline_mae, r.mae - b.mae AS delta_mae
 FROM {_RUNS} r LEFT JOIN {_RUNS} b ON r.parent_run_id = b.run_id""",
       d="mae baseline_mae delta_mae")
def baseline_delta(t):
    return K.baseline_delta(_runs(t), ["mae"]).select("run_id", "mae", "baseline_mae", "delta_mae")


@query("metric_history", """SELECT event_type AS run_id, event_id AS step, 'mae' AS metric, value FROM
 (SELECT event_type, event_id, avg(abs(value - k)) OVER (PARTITION BY event_type ORDER BY event_id
 ROWS UNBOUNDED PRECEDING) AS value FROM (SELECT *, (props->>'k')::DOUBLE AS k FROM events))
 WHERE event_id % 100 = 0""", d="value")
def metric_history(t):
    rows = ordered_errors(t.events).select("event_id", "event_type", "y", "yhat")
    run = R.running_means(rows, ["event_type"], "event_id",
                          {"mae": F.abs(F.col("y") - F.col("yhat"))})
    return K.metric_history(R.every(run, "event_id", 100), "event_type", "event_id", ["mae"])


@query("restore_offset", """SELECT event_type AS topic, user_id % 3 AS partition,
 max(event_id) + 1 AS next_offset FROM events GROUP BY 1, 2""")
def restore_offset(t):
    commits = t.events.select(F.col("event_type").alias("topic"),
                              (F.col("user_id") % 3).alias("partition"),
                              F.col("event_id").alias("last_offset"))
    return K.restore_offsets(commits)
