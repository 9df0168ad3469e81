"""Guarded SQL, result grid and the ready-made queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml.operators.profile import value_list  # noqa: F401
from rtml.plans import canned
from rtml.plans.sqlguard import grid_order, grid_page, grid_search, guarded, guarded_flagged
from rtml.suite.base import query
from rtml.suite.roles import INTERACTIONS_SQL, TRANSACTIONS_SQL, TRIPS_SQL, as_interactions, \
    as_transactions, as_trips

TFD, ETA, ECCI = ("transaction_fraud_detection", "estimated_time_of_arrival",
                  "e_commerce_customer_interactions")


@query("guarded_sql_result", """SELECT event_type, count(*) AS n, avg(value) AS avg_value FROM events
 GROUP BY event_type""", d="avg_value")
def guarded_sql_result(t):
    return guarded(t.events, "SELECT event_type, COUNT(*) AS n, AVG(value) AS avg_value "
                             "FROM data GROUP BY event_type ORDER BY n DESC")


@query("guarded_sql_self_join", """SELECT a.event_type, count(*) AS followed FROM events a JOIN events b
 ON a.user_id = b.user_id AND b.event_id = a.event_id + 1 GROUP BY a.event_type""")
def guarded_sql_self_join(t):
    """A joined table name is bound too, unlike by text replacement."""
    return guarded(t.events, "SELECT a.event_type, COUNT(*) AS followed FROM data a JOIN data b ON "
                             "a.user_id = b.user_id AND b.event_id = a.event_id + 1 "
                             "GROUP BY a.event_type")


@query("guarded_sql_rollup", """SELECT l_returnflag, l_linestatus, count(*) AS n,
 sum(l_quantity) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
       d="quantity")
def guarded_sql_rollup(t):
    return guarded(t.lineitem, "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, "
                               "SUM(l_quantity) AS quantity FROM data "
                               "GROUP BY ROLLUP (l_returnflag, l_linestatus)")


_CTE = """WITH totals AS (SELECT user_id, SUM(value) AS total FROM {t} GROUP BY user_id)
 SELECT COUNT(*) AS users, SUM(total) AS total, MIN(user_id) AS first_user FROM totals
 WHERE total > (SELECT AVG(total) FROM totals)"""
_SETS = """SELECT COUNT(*) AS users, SUM(user_id) AS ids FROM (
 SELECT user_id FROM {t} WHERE event_type = 'purchase' INTERSECT
 SELECT user_id FROM {t} WHERE event_type = 'error' EXCEPT
 SELECT user_id FROM {t} WHERE event_type = 'signup' AND value > 300)"""


@query("guarded_sql_cte", _CTE.format(t="events"), d="total", digits=4)
def guarded_sql_cte(t):
    return guarded(t.events, _CTE.format(t="data"), mode="lax")


@query("guarded_sql_set_ops", _SETS.format(t="events"), i="ids")
def guarded_sql_set_ops(t):
    return guarded(t.events, _SETS.format(t="data"))


@query("guarded_sql_truncated", """SELECT event_id, event_type, true AS truncated FROM events
 ORDER BY event_id LIMIT 100""")
def guarded_sql_truncated(t):
    """More rows than the cap allows: the first ones, and the flag."""
    return guarded_flagged(t.events, "SELECT event_id, event_type FROM data ORDER BY event_id", 100)


def _same(name: str, sql: str, table: str, **kw):
    """One text for both engines, the table being ``data`` under the guard."""
    @query(name, sql.format(t=table), **kw)
    def run(t):
        return guarded(getattr(t, table), sql.format(t="data"), mode="lax")
    return run


_same("guarded_sql_outer_join", """SELECT a.event_type, COUNT(*) AS n, COUNT(b.event_id) AS followed
 FROM {t} a LEFT JOIN {t} b ON a.user_id = b.user_id AND b.event_id = a.event_id + 1
 GROUP BY a.event_type""", "events")
_same("guarded_sql_full_join", """SELECT buys, errors, COUNT(*) AS users, SUM(user_id) AS id_sum
 FROM (SELECT COALESCE(a.user_id, b.user_id) AS user_id, a.n AS buys, b.n AS errors
 FROM (SELECT user_id, COUNT(*) AS n FROM {t} WHERE event_type = 'purchase'
 GROUP BY user_id) a FULL OUTER JOIN (SELECT user_id, COUNT(*) AS n FROM {t}
 WHERE event_type = 'error' GROUP BY user_id) b ON a.user_id = b.user_id) j
 GROUP BY buys, errors""", "events", i="id_sum")
_same("guarded_sql_semi_join", """SELECT event_type, COUNT(*) AS n FROM {t} a
 WHERE EXISTS (SELECT 1 FROM {t} b WHERE b.user_id = a.user_id AND b.event_type = 'signup')
 GROUP BY event_type""", "events")
_same("guarded_sql_anti_join", """SELECT event_type, COUNT(*) AS n FROM {t} a
 WHERE NOT EXISTS (SELECT 1 FROM {t} b WHERE b.user_id = a.user_id AND b.event_type = 'error'
 AND b.event_id > a.event_id) GROUP BY event_type""", "events")
_same("guarded_sql_cube", """SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM {t}
 GROUP BY CUBE (l_returnflag, l_linestatus)""", "lineitem")
_same("guarded_sql_grouping_sets", """SELECT l_returnflag, l_linenumber, SUM(l_quantity) AS quantity
 FROM {t} GROUP BY GROUPING SETS ((l_returnflag), (l_linenumber), ())""", "lineitem", d="quantity")
_same("guarded_sql_having_distinct", """SELECT l_linenumber, COUNT(DISTINCT l_suppkey) AS suppliers
 FROM {t} GROUP BY l_linenumber HAVING COUNT(*) > 10""", "lineitem")
_same("guarded_sql_windows", """SELECT user_id, before, COUNT(*) AS n, SUM(rn) AS rn_sum,
 SUM(rn * event_id) AS place_sum, SUM(recent) AS recent FROM (SELECT user_id, event_id,
 ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
 LAG(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before,
 SUM(value) OVER (PARTITION BY user_id ORDER BY event_id
 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent FROM {t}) w
 GROUP BY user_id, before""", "events", d="recent", i="rn_sum place_sum", digits=3)
_same("guarded_sql_correlated", """SELECT o_orderpriority, COUNT(*) AS n FROM {t} o
 WHERE o_totalprice > (SELECT AVG(i.o_totalprice) FROM {t} i WHERE i.o_custkey = o.o_custkey)
 GROUP BY o_orderpriority""", "orders")
_same("guarded_sql_scalars", """SELECT UPPER(event_type) AS kind, LENGTH(event_type) AS len,
 COALESCE(NULLIF(event_type, 'error'), 'none') AS kept, SUBSTRING(event_type, 1, 3) AS head,
 SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS large, ROUND(MAX(ABS(value)), 2) AS top
 FROM {t} GROUP BY event_type""", "events", d="top", i="large len")


@query("grid_search_sort_page", """SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders
 WHERE contains(lower(o_orderkey::VARCHAR), 'urgent') OR contains(lower(o_custkey::VARCHAR), 'urgent')
 OR contains(lower(o_orderpriority), 'urgent') ORDER BY o_totalprice DESC, o_orderkey
 LIMIT 50 OFFSET 50""", d="o_totalprice", digits=2)
def grid_search_sort_page(t):
    grid = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    found = grid_search(grid, "URGENT")
    return grid_page(found, [*grid_order("o_totalprice", descending=True), "o_orderkey"], page=2)


@query("canned_sample", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 100",
       d="value", digits=2)
def canned_sample(t):
    return canned.sample_rows(t.events.select("event_id", "event_type", "value"), order="event_id")


@query("canned_purchases", """SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'
 ORDER BY event_id LIMIT 100""", d="value", digits=2)
def canned_purchases(t):
    rows = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    return canned.sample_rows(rows, order="event_id")


@query("canned_range_filter", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000
 ORDER BY o_orderkey LIMIT 100""", d="o_totalprice", digits=2)
def canned_range_filter(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return canned.sample_rows(rows, F.col("o_totalprice") > 1000, "o_orderkey")


@query("canned_top_merchants", f"""SELECT merchant_id, count(*) AS fraud_count FROM {TRANSACTIONS_SQL}
 WHERE is_fraud = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def canned_top_merchants(t):
    return canned.CANNED[TFD]["fraud_by_merchant"](as_transactions(t.lineitem))


@query("canned_group_avg", f"""SELECT transaction_type, count(*) AS count, avg(amount) AS avg_amount
 FROM {TRANSACTIONS_SQL} GROUP BY 1""", d="avg_amount", digits=4)
def canned_group_avg(t):
    return canned.CANNED[TFD]["transaction_types"](as_transactions(t.lineitem))


@query("canned_weather_impact", f"""SELECT weather, count(*) AS trips,
 avg(simulated_actual_travel_time_seconds) AS avg_time FROM {TRIPS_SQL} GROUP BY 1""",
       d="avg_time", digits=4)
def canned_weather_impact(t):
    return canned.CANNED[ETA]["weather_impact"](as_trips(t.orders))


@query("canned_driver_performance", f"""SELECT driver_id, count(*) AS trips,
 avg(driver_rating) AS avg_rating FROM {TRIPS_SQL} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
       d="avg_rating")
def canned_driver_performance(t):
    return canned.CANNED[ETA]["driver_performance"](as_trips(t.orders))


@query("canned_vehicle_types", f"""SELECT vehicle_type, count(*) AS count,
 avg(estimated_distance_km) AS avg_distance FROM {TRIPS_SQL} GROUP BY 1""", d="avg_distance")
def canned_vehicle_types(t):
    return canned.CANNED[ETA]["vehicle_types"](as_trips(t.orders))


@query("canned_by_category",
       f"SELECT product_category, count(*) AS count FROM {INTERACTIONS_SQL} GROUP BY 1")
def canned_by_category(t):
    return canned.CANNED[ECCI]["by_category"](as_interactions(t.events))


@query("canned_event_types", f"SELECT event_type, count(*) AS count FROM {INTERACTIONS_SQL} GROUP BY 1")
def canned_event_types(t):
    return canned.CANNED[ECCI]["event_types"](as_interactions(t.events))


@query("canned_conditional_sum", f"""SELECT product_id, count(*) AS views,
 sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases FROM {INTERACTIONS_SQL}
 GROUP BY 1 ORDER BY 2 DESC, product_id NULLS FIRST LIMIT 20""", i="purchases")
def canned_conditional_sum(t):
    return canned.CANNED[ECCI]["top_products"](as_interactions(t.events))


@query("canned_row_count", "SELECT count(*) AS total_rows FROM lineitem")
def canned_row_count(t):
    return canned.row_count(t.lineitem)


@query("canned_fraud_cases", f"""SELECT count(*) AS rows, count(*) FILTER (is_fraud = 1) AS fraud FROM
 (SELECT is_fraud FROM {TRANSACTIONS_SQL} WHERE is_fraud = 1 LIMIT 100)""")
def canned_fraud_cases(t):
    """Some rows of one class; which ones is not fixed."""
    return canned.CANNED[TFD]["fraud_cases"](as_transactions(t.lineitem)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_fraud") == 1).alias("fraud"))


@query("canned_long_trips", f"""SELECT count(*) AS rows, count(*) FILTER (estimated_distance_km > 50) AS long
 FROM (SELECT estimated_distance_km FROM {TRIPS_SQL} WHERE estimated_distance_km > 50 LIMIT 100)""")
def canned_long_trips(t):
    return canned.CANNED[ETA]["long_trips"](as_trips(t.orders)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("estimated_distance_km") > 50).alias("long"))
