"""The provided tables in the roles of the project tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtml.session import spread

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(c: str) -> Column:
    return F.concat(F.date_format(c, ISO), F.lit("+00:00"))


def as_transactions(lineitem: DataFrame) -> DataFrame:
    """Line items as card transactions (schema of the fraud table, columns that are used)."""
    return spread(lineitem).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        iso_text("l_shipdate").alias("timestamp"), F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("currency"),
        F.concat(F.lit("merchant_"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        F.col("l_linestatus").alias("product_category"),
        F.concat("l_returnflag", "l_linestatus").alias("transaction_type"),
        F.concat(F.lit("pay_"), F.col("l_linenumber").cast("string")).alias("payment_method"),
        F.to_json(F.struct(F.col("l_linestatus").alias("os"),
                           F.col("l_returnflag").alias("browser"))).alias("device_info"),
        F.col("l_quantity").cast("int").alias("account_age_days"),
        (F.col("l_tax") > 0.04).alias("cvv_provided"),
        (F.col("l_discount") > 0.05).alias("billing_address_match"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_fraud"))


TRANSACTIONS_SQL = """(SELECT l_shipdate AS ts, l_extendedprice AS amount, l_returnflag AS currency,
 'merchant_' || l_suppkey AS merchant_id, l_linestatus AS product_category,
 l_returnflag || l_linestatus AS transaction_type, 'pay_' || l_linenumber AS payment_method,
 l_returnflag AS browser, l_linestatus AS os, l_quantity::BIGINT AS account_age_days,
 (l_tax > 0.04)::BIGINT AS cvv_provided, (l_discount > 0.05)::BIGINT AS billing_address_match,
 (l_returnflag = 'R')::BIGINT AS is_fraud FROM lineitem)"""


def as_trips(orders: DataFrame) -> DataFrame:
    """Orders as trips; trip id, origin and destination are the near-unique dictionaries."""
    def text(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    cust, order = F.col("o_custkey"), F.col("o_orderkey")
    return spread(orders).select(
        text("trip_", order.cast("string")).alias("trip_id"),
        text("driver_", cust.cast("string")).alias("driver_id"),
        text("vehicle_", (cust % 90).cast("string")).alias("vehicle_id"),
        iso_text("o_orderdate").alias("timestamp"),
        text('{"lat": 29.', (cust % 500).cast("string"), ', "lon": -95.',
             (order % 700).cast("string"), "}").alias("origin"),
        text('{"lat": 30.', (order % 500).cast("string"), ', "lon": -95.',
             (cust % 700).cast("string"), "}").alias("destination"),
        (F.col("o_totalprice") / 1000).alias("estimated_distance_km"),
        F.col("o_orderstatus").alias("weather"),
        (cust % 30).cast("double").alias("temperature_celsius"),
        F.weekday("o_orderdate").alias("day_of_week"), F.hour("o_orderdate").alias("hour_of_day"),
        (F.lit(1.0) + cust % 4).alias("driver_rating"),
        F.col("o_orderpriority").alias("vehicle_type"),
        (cust % 1000 + 60).cast("int").alias("initial_estimated_travel_time_seconds"),
        F.floor(F.col("o_totalprice") / 100).cast("int")
        .alias("simulated_actual_travel_time_seconds"),
        (F.lit(1.0) + order % 3).alias("debug_traffic_factor"),
        (F.lit(1.0) + order % 2).alias("debug_weather_factor"),
        (order % 5 * 300).cast("int").alias("debug_incident_delay_seconds"),
        (F.lit(1.0) + cust % 2).alias("debug_driver_factor"))


TRIPS_SQL = """(SELECT 'trip_' || o_orderkey AS trip_id, 'driver_' || o_custkey AS driver_id,
 'vehicle_' || (o_custkey % 90) AS vehicle_id, o_orderdate AS ts,
 '{"lat": 29.' || (o_custkey % 500) || ', "lon": -95.' || (o_orderkey % 700) || '}' AS origin,
 '{"lat": 30.' || (o_orderkey % 500) || ', "lon": -95.' || (o_custkey % 700) || '}' AS destination,
 o_totalprice / 1000 AS estimated_distance_km, o_orderstatus AS weather,
 (o_custkey % 30)::DOUBLE AS temperature_celsius, isodow(o_orderdate) - 1 AS day_of_week,
 hour(o_orderdate) AS hour_of_day, 1.0::DOUBLE + o_custkey % 4 AS driver_rating,
 o_orderpriority AS vehicle_type,
 o_custkey % 1000 + 60 AS initial_estimated_travel_time_seconds,
 floor(o_totalprice / 100)::BIGINT AS simulated_actual_travel_time_seconds,
 1.0::DOUBLE + o_orderkey % 3 AS debug_traffic_factor,
 1.0::DOUBLE + o_orderkey % 2 AS debug_weather_factor,
 o_orderkey % 5 * 300 AS debug_incident_delay_seconds,
 1.0::DOUBLE + o_custkey % 2 AS debug_driver_factor FROM orders)"""


def event_key(events: DataFrame) -> DataFrame:
    """Events with the JSON number ``k`` decoded."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))


KEYED_SQL = "(SELECT *, (props->>'k')::BIGINT AS k FROM events)"


def as_interactions(events: DataFrame) -> DataFrame:
    """Events as shop interactions; a session is one user and day."""
    e = event_key(spread(events))
    kind = F.col("event_type")
    k = F.col("k")
    search = kind == "signup"
    mapped = F.when(kind == "view", "page_view").when(kind == "click", "add_to_cart") \
        .when(kind == "signup", "search").when(kind == "error", "leave_review").otherwise(kind)
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
        .alias("session_id"),
        iso_text("ts").alias("timestamp"), mapped.alias("event_type"),
        F.when(~search, F.concat(F.lit("prod_"), k.cast("string"))).alias("product_id"),
        F.when(~search, F.concat(F.lit("cat_"), (k % 12).cast("string")))
        .alias("product_category"),
        F.when(~search, F.col("value")).alias("price"),
        F.when(kind.isin("click", "purchase"), (k % 4 + 1).cast("int")).alias("quantity"),
        F.when(k % 3 == 0, F.concat(F.lit("https://ref.example/"), (k % 5).cast("string")))
        .alias("referrer_url"),
        F.to_json(F.struct(
            F.concat(F.lit("dev_"), (k % 3).cast("string")).alias("device_type"),
            F.concat(F.lit("br_"), (k % 4).cast("string")).alias("browser"),
            F.when(k % 7 != 0, F.concat(F.lit("os_"), (k % 5).cast("string"))).alias("os")))
        .alias("device_info"),
        F.to_json(F.struct((k / 10).alias("lat"), (F.col("user_id") / 10).alias("lon")))
        .alias("location"),
        (F.col("event_id") % 9 + 1).cast("int").alias("session_event_sequence"),
        (k + 5).cast("int").alias("time_on_page_seconds"))


INTERACTIONS_SQL = """(SELECT event_id, 'user_' || user_id AS customer_id, ts,
 user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
 CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
  WHEN 'signup' THEN 'search' WHEN 'error' THEN 'leave_review' ELSE event_type END AS event_type,
 CASE WHEN event_type <> 'signup' THEN 'prod_' || k END AS product_id,
 CASE WHEN event_type <> 'signup' THEN 'cat_' || (k % 12) END AS product_category,
 CASE WHEN event_type <> 'signup' THEN value END AS price,
 CASE WHEN event_type IN ('click', 'purchase') THEN k % 4 + 1 END AS quantity,
 CASE WHEN k % 3 = 0 THEN 'https://ref.example/' || (k % 5) END AS referrer_url,
 'dev_' || (k % 3) AS device_type, 'br_' || (k % 4) AS browser,
 CASE WHEN k % 7 <> 0 THEN 'os_' || (k % 5) END AS os, k / 10.0 AS lat, user_id / 10.0 AS lon,
 event_id % 9 + 1 AS session_event_sequence, k + 5 AS time_on_page_seconds
 FROM (SELECT *, (props->>'k')::BIGINT AS k FROM events))"""


def scored(lineitem: DataFrame) -> DataFrame:
    """Binary label, score with many ties, and hard prediction from line items."""
    p = F.round(F.col("l_discount") * 0.6 / 0.10 + F.col("l_tax") * 0.4 / 0.08, 6)
    return lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                           p.alias("p"), (p >= 0.5).cast("int").alias("yhat"), "l_returnflag")


SCORED_SQL = """(SELECT y, p, (p >= 0.5)::INT AS yhat, l_returnflag FROM (
 SELECT (l_returnflag = 'R')::INT AS y,
 round(l_discount * 0.6 / 0.10 + l_tax * 0.4 / 0.08, 6) AS p, l_returnflag FROM lineitem))"""


def regression_pairs(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice")
    return lineitem.select(price.alias("y"), (price * (1 - F.col("l_discount")) *
                                              (1 + F.col("l_tax"))).alias("yhat"), "l_linestatus")


PAIRS_SQL = """(SELECT l_extendedprice AS y,
 l_extendedprice * (1 - l_discount) * (1 + l_tax) AS yhat, l_linestatus FROM lineitem)"""


def ordered_errors(events: DataFrame) -> DataFrame:
    """Events as an ordered stream: target value, prediction k, label purchase."""
    return event_key(events).select(
        "event_id", "ts", "event_type", F.col("value").alias("y"),
        F.col("k").cast("double").alias("yhat"),
        (F.col("event_type") == "purchase").cast("int").alias("hit"),
        (F.col("k") / 100).alias("score"), "user_id")


ERRORS_SQL = """(SELECT event_id, ts, event_type, value AS y, k::DOUBLE AS yhat,
 (event_type = 'purchase')::INT AS hit, k / 100.0 AS score, user_id FROM
 (SELECT *, (props->>'k')::BIGINT AS k FROM events))"""
