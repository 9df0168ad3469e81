"""Feature tables and scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rtml import schemas as S
from rtml.functions import scalars as X
from rtml.functions.validate import validate
from rtml.plans.features import customer_features, feature_dictionary, serving_features, \
    training_features
from rtml.suite.base import query
from rtml.suite.roles import INTERACTIONS_SQL, KEYED_SQL, TRANSACTIONS_SQL, TRIPS_SQL, \
    as_interactions, as_transactions, as_trips, event_key

_PARTS = {p: f"{p}(ts)" for p in S.TIME_PARTS}


def _codes(names: list[str]) -> str:
    return ", ".join(f"dense_rank() OVER (ORDER BY {_PARTS.get(n, n)} NULLS LAST) - 1 AS {n}"
                     for n in names)


@query("tfd_features", f"SELECT {', '.join(S.TFD_NUMERIC)}, {_codes(S.TFD_CATEGORICAL)}, is_fraud "
       f"FROM {TRANSACTIONS_SQL}", d="amount",
       i="account_age_days cvv_provided billing_address_match is_fraud")
def tfd_features(t):
    return training_features(as_transactions(t.lineitem), "transaction_fraud_detection")


@query("eta_features", f"SELECT {', '.join(S.ETA_NUMERIC)}, {_codes(S.ETA_CATEGORICAL)}, "
       f"{S.ETA_TARGET} FROM {TRIPS_SQL}", i="hour_of_day initial_estimated_travel_time_seconds "
       f"debug_incident_delay_seconds {S.ETA_TARGET}",
       d="estimated_distance_km temperature_celsius driver_rating debug_traffic_factor "
         "debug_weather_factor debug_driver_factor")
def eta_features(t):
    return training_features(as_trips(t.orders), "estimated_time_of_arrival")


_ECCI_FILLED = ", ".join(
    [f"coalesce({c}, 0) AS {c}" for c in S.ECCI_NUMERIC] +
    [f"coalesce({c}, 'unknown') AS {c}" for c in S.ECCI_CATEGORICAL if c not in S.TIME_PARTS])


@query("ecci_features", f"SELECT {', '.join(S.ECCI_NUMERIC)}, {_codes(S.ECCI_CATEGORICAL)} FROM "
       f"(SELECT ts, {_ECCI_FILLED} FROM {INTERACTIONS_SQL})", d="price",
       i="quantity session_event_sequence time_on_page_seconds")
def ecci_features(t):
    return training_features(as_interactions(t.events), "e_commerce_customer_interactions")


@query("serving_features", f"SELECT {', '.join(S.TFD_NUMERIC)}, {_codes(S.TFD_CATEGORICAL)} "
       f"FROM {TRANSACTIONS_SQL}", d="amount",
       i="account_age_days cvv_provided billing_address_match")
def serving(t):
    events = as_transactions(t.lineitem)
    project = "transaction_fraud_detection"
    return serving_features(events, project, feature_dictionary(events, project))


@query("customer_rfm", f"""
SELECT customer_id, count(DISTINCT session_id) AS total_sessions, count(*) AS total_events,
 avg(time_on_page_seconds) AS avg_time_on_page, sum(time_on_page_seconds) AS total_time_on_site,
 count(*) / count(DISTINCT session_id) AS avg_events_per_session,
 count(*) FILTER (event_type = 'purchase') AS total_purchases,
 coalesce(sum(paid), 0) AS total_revenue,
 coalesce(sum(paid) / nullif(count(*) FILTER (event_type = 'purchase'), 0), 0) AS avg_order_value,
 count(*) FILTER (event_type = 'page_view') AS page_views,
 count(*) FILTER (viewed) AS product_views,
 count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
 count(*) FILTER (event_type = 'search') AS searches,
 count(DISTINCT CASE WHEN viewed THEN product_id END) AS unique_products_viewed,
 count(DISTINCT CASE WHEN viewed THEN product_category END) AS unique_categories_viewed,
 min(best_hour) AS preferred_hour, count(DISTINCT ts::DATE) AS days_active,
 count(DISTINCT round(lat, 2)::VARCHAR || ',' || round(lon, 2)::VARCHAR) AS geo_diversity,
 coalesce(count(*) FILTER (event_type = 'add_to_cart') / nullif(count(*) FILTER (viewed), 0), 0)
  AS view_to_cart_rate,
 coalesce(count(*) FILTER (event_type = 'purchase')
  / nullif(count(*) FILTER (event_type = 'add_to_cart'), 0), 0) AS cart_to_purchase_rate
FROM (SELECT *, event_type = 'page_view' AND product_id IS NOT NULL AS viewed,
 CASE WHEN event_type = 'purchase' THEN price * coalesce(quantity, 1) END AS paid
 FROM {INTERACTIONS_SQL})
JOIN (SELECT customer_id, arg_min(h, [-n, h]) AS best_hour FROM (SELECT customer_id, hour(ts) AS h,
 count(*) AS n FROM {INTERACTIONS_SQL} GROUP BY 1, 2) GROUP BY 1) USING (customer_id) GROUP BY customer_id""",
       d="avg_time_on_page avg_events_per_session total_revenue avg_order_value view_to_cart_rate "
         "cart_to_purchase_rate", i="total_time_on_site preferred_hour", digits=4)
def customer_rfm(t):
    return customer_features(as_interactions(t.events))


@query("json_flatten_known", """SELECT o_orderkey, o_orderstatus AS os, o_orderpriority AS browser,
 o_custkey / 100.0 AS lat, o_orderkey / 100.0 AS lon FROM orders""", d="lat lon")
def json_flatten_known(t):
    landed = t.orders.select("o_orderkey", F.to_json(F.struct(
        F.col("o_orderstatus").alias("os"), F.col("o_orderpriority").alias("browser")))
        .alias("device_info"), F.to_json(F.struct(
            (F.col("o_custkey") / 100).alias("lat"), (F.col("o_orderkey") / 100).alias("lon")))
        .alias("location"))
    both = landed.select("o_orderkey", X.json_struct(F.col("device_info"), S.DEVICE).alias("d"),
                         X.json_struct(F.col("location"), S.LOCATION).alias("l"))
    return both.select("o_orderkey", "d.os", "d.browser", "l.lat", "l.lon")


@query("json_flatten_dynamic",
       "SELECT event_id, event_type, props->>'k' AS props_k FROM events")
def json_flatten_dynamic(t):
    return X.json_flatten(t.events.select("event_id", "event_type", "props"), "props")


@query("json_safe_default", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -1
 ELSE (props->>'k')::BIGINT END AS k FROM events""")
def json_safe_default(t):
    """Every fifth document is broken on purpose."""
    text = F.when(F.col("event_id") % 5 == 0, F.lit("{not json")).otherwise(F.col("props"))
    return t.events.select("event_id", X.json_or_default(text, "k bigint", {"k": -1})["k"]
                           .alias("k"))


@query("timestamp_parts", """SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day,
 hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second FROM events""",
       i="year month day hour minute second")
def timestamp_parts(t):
    parsed = as_interactions(t.events).select(
        F.col("event_id").cast("long").alias("event_id"),
        X.parse_timestamp(F.col("timestamp")).alias("_t"))
    return parsed.withColumns(X.time_parts(F.col("_t"))).drop("_t")


@query("calendar_flags", """SELECT event_id, isodow(ts) - 1 AS day_of_week, hour(ts) AS hour_of_day,
 hour(ts) BETWEEN 6 AND 9 AS is_morning_rush, hour(ts) BETWEEN 16 AND 19 AS is_evening_rush,
 isodow(ts) >= 6 AS is_weekend FROM events""", i="day_of_week hour_of_day")
def calendar_flags(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in
                                         X.calendar_flags(F.col("ts")).items()])


@query("haversine_baseline", """SELECT o_orderkey, km,
 greatest(60, floor(km / 40.0 * 3600)::BIGINT) AS baseline_seconds FROM (SELECT o_orderkey,
 round(2 * 6371 * asin(least(1.0, sqrt(pow(sin(radians(b1 - a1) / 2), 2) + cos(radians(a1)) *
 cos(radians(b1)) * pow(sin(radians(b2 - a2) / 2), 2)))), 2) AS km FROM (SELECT o_orderkey,
 29.5 + (o_custkey % 600) / 1000.0 AS a1, -95.8 + (o_orderkey % 800) / 1000.0 AS a2,
 29.5 + (o_orderkey % 590) / 1000.0 AS b1, -95.8 + (o_custkey % 790) / 1000.0 AS b2 FROM orders))""",
       d="km", i="baseline_seconds", digits=2)
def haversine_baseline(t):
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    km = X.haversine_km(29.5 + (c % 600) / 1000, -95.8 + (o % 800) / 1000,
                        29.5 + (o % 590) / 1000, -95.8 + (c % 790) / 1000)
    return t.orders.select("o_orderkey", km.alias("km")) \
        .withColumn("baseline_seconds", X.baseline_seconds(F.col("km")))


@query("record_validation", """SELECT failed, count(*) AS n FROM (SELECT CASE WHEN event_id % 7 = 0
 THEN 'amount' WHEN event_id % 11 = 0 THEN 'kind' ELSE '' END AS failed FROM events) GROUP BY 1""")
def record_validation(t):
    """Amounts are unreadable in every 7th record, kinds missing in every 11th other one."""
    i = F.col("event_id")
    raw = t.events.select(
        i.cast("string").alias("id"),
        F.when(i % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when((i % 11 == 0) & (i % 7 != 0), None).otherwise(F.col("event_type")).alias("kind"))
    checked = validate(raw, "id bigint, amount double, kind string")
    return checked.groupBy(F.array_join("_failed", ",").alias("failed")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("nonfinite_clean", """SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 2) THEN NULL ELSE value
 END AS cleaned, CASE WHEN event_id % 6 IN (0, 1, 2) THEN 0 ELSE value END AS filled FROM events""",
       d="cleaned filled")
def nonfinite_clean(t):
    i = F.col("event_id") % 6
    x = F.when(i == 0, F.lit(float("nan"))).when(i == 1, F.lit(float("inf"))) \
        .when(i == 2, F.lit(float("-inf"))).otherwise(F.col("value"))
    return t.events.select("event_id", X.finite_or_null(x).alias("cleaned"),
                           X.finite_or(x, 0.0).alias("filled"))


@query("numeric_coerce", """SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 4 = 0 THEN
 event_type ELSE value::VARCHAR END AS DOUBLE), 0) AS number FROM events""", d="number")
def numeric_coerce(t):
    text = F.when(F.col("event_id") % 4 == 0, F.col("event_type")) \
        .otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", X.to_number(text).alias("number"))


@query("impute_merge", """SELECT event_id, coalesce(price, 0) AS price, coalesce(os, 'False') AS os,
 upper(event_type) AS event_type FROM """ + INTERACTIONS_SQL, d="price")
def impute_merge(t):
    rows = as_interactions(t.events).select(
        F.col("event_id").cast("long").alias("event_id"), "event_type", "price",
        X.json_text(F.col("device_info"), "os").alias("os"))
    filled = X.impute(X.impute(rows, ["price"], False), ["os"], "False")
    return X.merge_records(filled, filled.columns, {"event_type": F.upper("event_type")})


@query("url_slug", """SELECT p_partkey, replace(replace(lower(p_type || ' & ' || p_brand), ' & ', '-'),
 ' ', '-') AS slug, 'https://shop.example/search?q=' || replace(p_type, ' ', '+') AS url,
 p_type AS query, p_partkey AS number FROM part""")
def url_slug(t):
    both = F.concat("p_type", F.lit(" & "), "p_brand")
    url = X.query_url("https://shop.example/search", F.col("p_type"))
    return t.part.select("p_partkey", X.url_slug(both).alias("slug"), url.alias("url"),
                         X.query_of_url(url).alias("query"),
                         X.id_number(X.make_id("part", F.col("p_partkey")), "part")
                         .alias("number"))


@query("ordered_projection", f"""SELECT event_type, user_id, coalesce(value, 0) AS price,
 (value > 50)::BIGINT AS is_high, k, round(value, 1) AS value_1 FROM {KEYED_SQL}""",
       d="price value_1")
def ordered_projection(t):
    rows = event_key(t.events).withColumns({
        "price": X.default_value(F.col("value"), 0.0),
        "is_high": X.bool_to_int(F.col("value") > 50),
        "value_1": X.round_metric(F.col("value"), 1)})
    return X.project(rows, ["event_type", "user_id", "price", "is_high", "k", "value_1"])


def flagship(t):
    """Encoded interactions counted per event-type code and hour with revenue."""
    return training_features(as_interactions(t.events), "e_commerce_customer_interactions") \
        .groupBy("event_type", "hour").agg(F.count(F.lit(1)).alias("n"),
                                           F.round(F.sum("price"), 2).alias("revenue"))
