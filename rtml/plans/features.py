"""Feature tables of the three projects, for training and for serving.

Training and serving share the same decoding and column order; they differ only in where the label
codes come from (ranked from the table, or looked up in a stored dictionary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtml import schemas as S
from rtml.functions.scalars import bool_to_int, json_struct, parse_timestamp, time_parts
from rtml.operators.encode import SMALL_DICTIONARY, apply_dictionary, label_dictionary, \
    label_encode
from rtml.operators.sample import percent_sample
from rtml.session import spread


def _with_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Date parts from one parse of the event time."""
    parsed = df.withColumn("_ts", parse_timestamp(F.col(column)))
    return parsed.withColumns(time_parts(F.col("_ts"))).drop("_ts")


def _with_device(df: DataFrame) -> DataFrame:
    parsed = df.withColumn("_device", json_struct(F.col("device_info"), S.DEVICE))
    return parsed.withColumns({k: F.col(f"_device.{k}") for k in ("browser", "device_type", "os")}) \
        .drop("_device")


def decode_transactions(df: DataFrame) -> DataFrame:
    out = _with_device(_with_time(df)).withColumns({
        "cvv_provided": bool_to_int(F.col("cvv_provided")),
        "billing_address_match": bool_to_int(F.col("billing_address_match"))})
    return out.select(*S.TFD_NUMERIC, *S.TFD_CATEGORICAL, S.TFD_TARGET)


def decode_trips(df: DataFrame) -> DataFrame:
    return _with_time(df).select(*S.ETA_NUMERIC, *S.ETA_CATEGORICAL, S.ETA_TARGET)


def decode_interactions(df: DataFrame) -> DataFrame:
    out = _with_device(_with_time(df)).withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in S.ECCI_NUMERIC} |
        {c: F.coalesce(c, F.lit("unknown")) for c in
         ("event_type", "product_category", "product_id", "referrer_url", "browser",
          "device_type", "os")})
    return out.select(*S.ECCI_NUMERIC, *S.ECCI_CATEGORICAL)


PROJECTS = {
    "transaction_fraud_detection": (decode_transactions, S.TFD_NUMERIC, S.TFD_CATEGORICAL,
                                    S.TFD_TARGET),
    "estimated_time_of_arrival": (decode_trips, S.ETA_NUMERIC, S.ETA_CATEGORICAL, S.ETA_TARGET),
    "e_commerce_customer_interactions": (decode_interactions, S.ECCI_NUMERIC, S.ECCI_CATEGORICAL,
                                         None),
}


def training_features(events: DataFrame, project: str, sample_percent: float | None = None,
                      max_rows: int | None = None,
                      small_limit: int = SMALL_DICTIONARY) -> DataFrame:
    """Ordered all-numeric feature table (target last).

    A sample is drawn before the codes are ranked, a row cap is applied after: codes come from the
    sample in the first case and from the whole table in the second.
    """
    if sample_percent is not None and max_rows is not None:
        raise ValueError("give sample_percent or max_rows, not both")
    decode, numeric, categorical, target = PROJECTS[project]
    rows = decode(spread(events))
    if sample_percent is not None:
        rows = percent_sample(rows, sample_percent)
    coded = label_encode(rows, categorical, small_limit=small_limit)
    out = coded.select(*numeric, *categorical, *([target] if target else []))
    return out.limit(max_rows) if max_rows is not None else out


def feature_dictionary(events: DataFrame, project: str) -> DataFrame:
    decode, _, categorical, _ = PROJECTS[project]
    return label_dictionary(decode(spread(events)), categorical)


def serving_features(events: DataFrame, project: str, dictionary: DataFrame,
                     unknown: str = "zero", keep: list[str] | None = None) -> DataFrame:
    """Same columns in the same order, codes looked up in the stored dictionary."""
    decode, numeric, categorical, _ = PROJECTS[project]
    rows = decode(spread(events))
    coded = apply_dictionary(rows, dictionary, categorical, unknown, suffix="_code")
    return coded.select(*numeric, *[F.col(f"{c}_code").alias(c) for c in categorical])


def customer_features(events: DataFrame) -> DataFrame:
    """One row per customer with the 19 engagement features.

    sessions: distinct session ids; views, carts, searches, purchases: counts by event type;
    product views: page views that name a product; revenue: price x quantity (1 when missing) of
    purchases; preferred hour: most frequent, smallest on a tie; geo diversity: distinct
    coordinates rounded to two decimals; a rate without denominator is 0.
    """
    kind = F.col("event_type")
    viewed = (kind == "page_view") & F.col("product_id").isNotNull()
    place = json_struct(F.col("location"), S.LOCATION)
    rows = spread(events).withColumn("_ts", parse_timestamp(F.col("timestamp"))).withColumns({
        "_hour": F.hour("_ts"), "_day": F.to_date("_ts"),
        "_geo": F.when(place.isNotNull() & place["lat"].isNotNull(),
                       F.concat_ws(",", F.round(place["lat"], 2), F.round(place["lon"], 2))),
        "_paid": F.when(kind == "purchase",
                        F.col("price") * F.coalesce(F.col("quantity"), F.lit(1)))})
    plain = rows.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("time_on_page_seconds").alias("avg_time_on_page"),
        F.sum("time_on_page_seconds").alias("total_time_on_site"),
        F.count_if(kind == "purchase").alias("total_purchases"),
        F.coalesce(F.sum("_paid"), F.lit(0.0)).alias("total_revenue"),
        F.count_if(kind == "page_view").alias("page_views"),
        F.count_if(viewed).alias("product_views"),
        F.count_if(kind == "add_to_cart").alias("add_to_carts"),
        F.count_if(kind == "search").alias("searches"))
    # distinct values of all kinds are counted per customer first, then the kinds are told apart
    kinds = {"total_sessions": F.col("session_id"),
             "unique_products_viewed": F.when(viewed, F.col("product_id")),
             "unique_categories_viewed": F.when(viewed, F.col("product_category")),
             "days_active": F.col("_day"), "geo_diversity": F.col("_geo"),
             "preferred_hour": F.col("_hour")}
    values = rows.select("customer_id", F.explode(F.array(*[
        F.struct(F.lit(name).alias("kind"), value.cast("string").alias("value"))
        for name, value in kinds.items()])).alias("p")).where("p.value IS NOT NULL") \
        .groupBy("customer_id", "p.kind", "p.value").agg(F.count(F.lit(1)).alias("n"))
    hour = F.when(F.col("kind") == "preferred_hour", F.struct("n", (-F.col("value").cast("int")).alias("h")))
    distinct = values.groupBy("customer_id").agg(
        *[F.count_if(F.col("kind") == name).alias(name) for name in kinds if name != "preferred_hour"],
        (-F.max(hour)["h"]).alias("preferred_hour"))
    both = plain.unionByName(distinct, allowMissingColumns=True).groupBy("customer_id")
    names = [*plain.columns[1:], *distinct.columns[1:]]
    grouped = both.agg(*[F.max(c).alias(c) for c in names]) \
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in kinds if c != "preferred_hour"})

    def rate(a: str, b: str):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")),
                          F.lit(0.0))

    return grouped.withColumns({
        "avg_events_per_session": rate("total_events", "total_sessions"),
        "avg_order_value": rate("total_revenue", "total_purchases"),
        "view_to_cart_rate": rate("add_to_carts", "product_views"),
        "cart_to_purchase_rate": rate("total_purchases", "add_to_carts"),
    }).select("customer_id", *S.CUSTOMER_FEATURES)
