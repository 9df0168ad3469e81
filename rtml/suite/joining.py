"""Range joins, as-of joins and sliding curves over the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtml.operators import joins as J
from rtml.operators.sliding import sliding_auc
from rtml.plans.sqlguard import guarded
from rtml.suite.base import Tables, query

_HOUR = "INTERVAL 1 HOUR"


def _buys(t: Tables) -> DataFrame:
    """Purchases as the hour after them."""
    return t.events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("buyer"), F.col("event_id").alias("buy_id"),
        F.col("ts").alias("bought"), (F.col("ts") + F.expr(_HOUR)).alias("until"), F.col("value").alias("paid"))


def _keyed(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("buyer"), "event_id", "event_type", "ts", "value")


@query("range_join_after_purchase", """SELECT e.event_id, count(b.event_id) AS buys,
 sum(b.value) AS paid FROM events e LEFT JOIN events b ON b.event_type = 'purchase'
 AND b.user_id = e.user_id AND e.ts BETWEEN b.ts AND b.ts + INTERVAL 1 HOUR GROUP BY e.event_id""",
       d="paid", digits=3)
def range_join_after_purchase(t):
    """Every event with the purchases of its user in the hour before it."""
    met = J.interval_join(_keyed(t.events), _buys(t), "ts", "bought", "until", ["buyer"], how="left")
    return met.groupBy("event_id").agg(F.count("buy_id").alias("buys"), F.sum("paid").alias("paid"))


@query("range_join_price_band", """SELECT p_brand, count(*) AS n, sum(l_quantity) AS quantity
 FROM part JOIN lineitem ON l_extendedprice >= p_retailprice * 20
 AND l_extendedprice < p_retailprice * 20 + p_size GROUP BY p_brand""", d="quantity", digits=2)
def range_join_price_band(t):
    """No equal key at all: prices inside half-open bands."""
    bands = t.part.select("p_brand", (F.col("p_retailprice") * 20).alias("low"),
                          (F.col("p_retailprice") * 20 + F.col("p_size")).alias("high"))
    met = J.interval_join(t.lineitem.select("l_extendedprice", "l_quantity"), bands,
                          "l_extendedprice", "low", "high", closed=False, by=["p_brand"],
                          sums=["l_quantity"])
    return met.withColumnRenamed("l_quantity", "quantity")


@query("overlap_join_hours", """SELECT a.event_type, b.event_type AS other, count(*) AS n
 FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id < b.event_id
 AND a.ts <= b.ts + INTERVAL 1 HOUR AND b.ts <= a.ts + INTERVAL 1 HOUR GROUP BY 1, 2""")
def overlap_join_hours(t):
    """Pairs of a user's events whose following hours overlap."""
    hours = _keyed(t.events).withColumn("until", F.col("ts") + F.expr(_HOUR))
    met = J.overlap_join(hours, hours, ("ts", "until"), ("ts", "until"), ["buyer"])
    return met.where("event_id < event_id_r").groupBy(
        "event_type", F.col("event_type_r").alias("other")).agg(F.count(F.lit(1)).alias("n"))


_LAST = """SELECT e.event_id, b.event_id AS buy_id, b.value AS paid FROM events e
 ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
 ON e.user_id = b.user_id AND e.ts > b.ts"""


@query("asof_join_last_purchase", _LAST, d="paid", digits=3)
def asof_join_last_purchase(t):
    """Every event with its user's latest purchase before it."""
    return J.asof_join(_keyed(t.events), _buys(t), "ts", "bought", ["buyer"], strict=True) \
        .select("event_id", "buy_id", "paid")


@query("asof_join_next_purchase", """SELECT e.event_id, b.event_id AS buy_id FROM events e
 ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
 ON e.user_id = b.user_id AND e.ts <= b.ts""")
def asof_join_next_purchase(t):
    return J.asof_join(_keyed(t.events), _buys(t), "ts", "bought", ["buyer"],
                       direction="forward").select("event_id", "buy_id")


@query("guarded_sql_range_relation", """SELECT e.event_type, count(*) AS n, avg(b.value) AS paid
 FROM events e JOIN events b ON b.event_type = 'purchase' AND b.user_id = e.user_id
 AND e.ts BETWEEN b.ts AND b.ts + INTERVAL 1 HOUR GROUP BY e.event_type""", d="paid", digits=4)
def guarded_sql_range_relation(t):
    """A range join under the guard: the text reads the joined rows by name."""
    met = J.interval_join(_keyed(t.events), _buys(t), "ts", "bought", "until", ["buyer"])
    return guarded(t.events, "SELECT event_type, COUNT(*) AS n, AVG(paid) AS paid FROM after_buy "
                             "GROUP BY event_type", relations={"after_buy": met})


@query("guarded_sql_asof_relation", f"""SELECT e.event_type, count(*) AS n, count(l.buy_id) AS after_buy,
 avg(l.paid - e.value) AS gap FROM ({_LAST}) l JOIN events e USING (event_id)
 GROUP BY e.event_type""", d="gap", digits=4)
def guarded_sql_asof_relation(t):
    last = asof_join_last_purchase(t)
    return guarded(t.events, "SELECT d.event_type, COUNT(*) AS n, COUNT(l.buy_id) AS after_buy, "
                             "AVG(l.paid - d.value) AS gap FROM last_buy l JOIN data d "
                             "ON d.event_id = l.event_id GROUP BY d.event_type",
                   relations={"last_buy": last})


@query("sliding_auc_5000", """WITH r AS (SELECT event_id, (event_type = 'purchase')::INT AS y, value AS p,
 row_number() OVER (ORDER BY event_id) AS rn FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
met AS (SELECT a.rn AS early, b.rn AS late, CASE WHEN a.p = b.p THEN 1
 WHEN (a.p > b.p) = (a.y = 1) THEN 2 ELSE 0 END AS s
 FROM r a JOIN r b ON a.rn < b.rn AND a.rn >= b.rn - 5000 WHERE a.y <> b.y),
moved AS (SELECT late AS spot, sum(s) AS s FROM met GROUP BY 1
 UNION ALL SELECT early + 5000, -sum(s) FROM met GROUP BY 1),
change AS (SELECT spot, sum(s) AS s FROM moved GROUP BY spot)
SELECT event_id, positives::BIGINT AS positives, negatives::BIGINT AS negatives,
 area / nullif(2.0 * positives * negatives, 0) AS auc FROM (
 SELECT event_id, sum(y) OVER w AS positives, sum(1 - y) OVER w AS negatives,
 sum(coalesce(s, 0)) OVER (ORDER BY rn) AS area FROM r LEFT JOIN change ON spot = rn
 WINDOW w AS (ORDER BY rn ROWS 4999 PRECEDING)) AS areas""", d="auc", digits=6)
def sliding_auc_5000(t):
    """Exact AUC of the last 5000 events at every event."""
    rows = t.events.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("y"),
                           "value")
    return sliding_auc(rows, [], "event_id", "y", "value", 5000)
