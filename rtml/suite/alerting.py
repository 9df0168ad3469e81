"""Metric series and alert rules over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators import alerts as A, profile as P
from rtml.suite.base import query
from rtml.suite.roles import KEYED_SQL, event_key

# The counter grows with k and restarts when k is divisible by 25.
_INC = """(SELECT *, CASE WHEN p IS NULL THEN NULL WHEN c >= p THEN c - p ELSE c END AS inc FROM
 (SELECT event_type, ts, event_id, c, lag(c) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM
 (SELECT event_type, ts, event_id, event_id % 500 AS c FROM events)))"""


def _counter(t):
    return t.events.select("event_type", "ts", "event_id", (F.col("event_id") % 500).alias("c"))


@query("counter_increments", f"SELECT event_id, event_type, inc AS increment FROM {_INC}")
def counter_increments(t):
    return A.counter_increments(_counter(t), ["event_type"], "ts", "c") \
        .select("event_id", "event_type", "increment")


@query("counter_rate_5m", f"""SELECT event_type, epoch_us(ts) // 300000000 * 300 AS window_start,
 coalesce(sum(inc), 0) AS increase, coalesce(sum(inc), 0) / 300.0 AS rate FROM {_INC} GROUP BY 1, 2""",
       d="rate", i="window_start increase")
def counter_rate_5m(t):
    return A.counter_rate(_counter(t), ["event_type"], "ts", "c", 300)


@query("instant_rate", f"""SELECT event_type, inc / ((epoch_us(ts) - epoch_us(pt)) / 1e6) AS irate FROM
 (SELECT *, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS pt FROM {_INC})
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1""", d="irate")
def instant_rate(t):
    return A.instant_rate(_counter(t), ["event_type"], "ts", "c")


@query("ratio_of_rates", f"""SELECT epoch_us(ts) // 3600000000 * 3600 AS window_start,
 sum(CASE WHEN event_type = 'error' THEN k ELSE 0 END) AS matched, sum(k) AS total,
 sum(CASE WHEN event_type = 'error' THEN k ELSE 0 END) / nullif(sum(k), 0) AS ratio
 FROM {KEYED_SQL} GROUP BY 1""", d="ratio", i="window_start matched total")
def ratio_of_rates(t):
    return A.ratio_of_rates(event_key(t.events), "ts", F.col("event_type") == "error",
                            F.col("k"), 3600)


_PAIRS = """(SELECT event_type, us, CASE WHEN c >= p THEN c - p ELSE c END AS inc, pus FROM
 (SELECT event_type, epoch_us(ts) AS us, event_id % 500 AS c, lag(event_id % 500) OVER w AS p,
 lag(epoch_us(ts)) OVER w AS pus FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts))
 WHERE p IS NOT NULL)"""
_SLIDING = f"""(SELECT event_type, step * 600 AS eval_time, sum(inc) AS increase, sum(inc) / 3600.0 AS rate FROM
 (SELECT event_type, inc, unnest(range((us + 599999999) // 600000000,
 (pus + 3600000000 + 599999999) // 600000000)) AS step FROM {_PAIRS}) GROUP BY 1, 2)"""


@query("sliding_rate", f"SELECT event_type, eval_time, increase, rate FROM {_SLIDING}", d="rate",
       i="eval_time increase")
def sliding_rate(t):
    return A.sliding_rate(_counter(t), ["event_type"], "ts", "c", 3600, 600)


@query("ratio_of_counters", f"""SELECT eval_time, sum(CASE WHEN event_type = 'error' THEN rate ELSE 0 END) /
 nullif(sum(rate), 0) AS ratio FROM {_SLIDING} GROUP BY eval_time""", d="ratio", i="eval_time")
def ratio_of_counters(t):
    return A.ratio_of_counters(_counter(t), ["event_type"], "ts", "c",
                               F.col("event_type") == "error", 3600, 600)


@query("average_instant_rate", """SELECT event_type, avg(irate) AS avg_irate, count(irate) AS series FROM
 (SELECT event_type, (CASE WHEN c >= p THEN c - p ELSE c END) / ((us - pus) / 1e6) AS irate FROM
 (SELECT event_type, user_id % 5 AS shard, epoch_us(ts) AS us, event_id % 500 AS c,
 lag(event_id % 500) OVER w AS p, lag(epoch_us(ts)) OVER w AS pus FROM events
 WINDOW w AS (PARTITION BY event_type, user_id % 5 ORDER BY ts))
 QUALIFY row_number() OVER (PARTITION BY event_type, shard ORDER BY us DESC) = 1)
 GROUP BY event_type""", d="avg_irate", digits=4)
def average_instant_rate(t):
    rows = _counter(t).join(t.events.select("event_id", (F.col("user_id") % 5).alias("shard")),
                            "event_id")
    return A.average_instant_rate(rows, ["event_type", "shard"], ["event_type"], "ts", "c")


_LE = [1, 5, 10, 25, 50, 100, 250, 500]


@query("bucket_quantile", f"""WITH h AS (SELECT event_type, le, count(*) FILTER (le IS NULL OR value <= le)
 AS cum FROM events CROSS JOIN (SELECT unnest({_LE} || [NULL])::DOUBLE AS le) GROUP BY 1, 2),
 w AS (SELECT *, coalesce(lag(le) OVER o, 0) AS lo, coalesce(lag(cum) OVER o, 0) AS bef,
 max(cum) OVER (PARTITION BY event_type) * 0.95 AS rank FROM h
 WINDOW o AS (PARTITION BY event_type ORDER BY le NULLS LAST))
 SELECT event_type, CASE WHEN le IS NULL THEN lo ELSE lo + (le - lo) * (rank - bef) / (cum - bef) END
 AS quantile FROM w WHERE cum >= rank
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY le NULLS LAST) = 1""", d="quantile")
def bucket_quantile(t):
    return A.bucket_quantile(P.bucket_histogram(t.events, "value", _LE, ["event_type"]),
                             ["event_type"], 0.95)


@query("alert_intervals", f"""SELECT event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started,
 strftime(min(ts) + INTERVAL 5 MINUTES, '%Y-%m-%d %H:%M:%S') AS firing_from,
 strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS samples FROM (SELECT *,
 sum((k <= 40)::INT) OVER (PARTITION BY event_type ORDER BY ts) AS island FROM {KEYED_SQL}) WHERE k > 40
 GROUP BY event_type, island HAVING max(ts) - min(ts) >= INTERVAL 5 MINUTES""")
def alert_intervals(t):
    found = A.alert_intervals(event_key(t.events), ["event_type"], "ts", F.col("k") > 40, 300)
    return found.select("event_type", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
                                        for c in ("started", "firing_from", "ended")], "samples")


@query("staleness", """SELECT user_id, (newest - max(epoch_us(ts))) / 1e6 AS age_seconds,
 (newest - max(epoch_us(ts))) / 1e6 > 36000 AS stale FROM events, (SELECT max(epoch_us(ts)) AS newest
 FROM events) GROUP BY user_id, newest""", d="age_seconds", digits=3)
def staleness(t):
    return A.staleness(t.events, ["user_id"], "ts", limit_seconds=36000)


@query("latest_sum_by_label", """SELECT event_type, sum(v) AS total, count(*) AS series FROM
 (SELECT event_type, user_id, arg_max(value, ts) AS v FROM events GROUP BY 1, 2) GROUP BY 1""",
       d="total", digits=4)
def latest_sum_by_label(t):
    return A.latest_sum(t.events, ["event_type", "user_id"], ["event_type"], "ts", "value")
