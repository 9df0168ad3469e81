"""The ready-made queries of each project, as functions over its event table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rtml.operators.profile import group_summary

ROWS = 100
TOP = 20


def sample_rows(df: DataFrame, condition: Column | None = None, order: str | None = None,
                rows: int = ROWS) -> DataFrame:
    """First rows that satisfy a condition; give an order to make the choice repeatable."""
    out = df if condition is None else df.where(condition)
    return (out.orderBy(order) if order else out).limit(rows)


def count_by(df: DataFrame, by: str, average: str | None = None, names=("count", "average"),
             condition: Column | None = None, top: int | None = None) -> DataFrame:
    """Counts (and a mean) per value, largest first, ties by value."""
    rows = df if condition is None else df.where(condition)
    aggs = {names[0]: F.count(F.lit(1))}
    if average:
        aggs[names[1]] = F.avg(average)
    return group_summary(rows, [by], aggs, [F.col(names[0]).desc(), F.col(by)], top)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def top_products(df: DataFrame, product: str = "product_id", kind: str = "event_type",
                 purchase: str = "purchase", top: int | None = TOP) -> DataFrame:
    return group_summary(df, [product], {
        "views": F.count(F.lit(1)), "purchases": F.count_if(F.col(kind) == purchase)},
        [F.col("views").desc(), F.col(product)], top)


Canned = Callable[[DataFrame], DataFrame]

CANNED: dict[str, dict[str, Canned]] = {
    "transaction_fraud_detection": {
        "sample": sample_rows,
        "fraud_cases": lambda d: sample_rows(d, F.col("is_fraud") == 1),
        "high_value": lambda d: sample_rows(d, F.col("amount") > 1000),
        "fraud_by_merchant": lambda d: count_by(d, "merchant_id", names=("fraud_count", ""),
                                                condition=F.col("is_fraud") == 1, top=TOP),
        "transaction_types": lambda d: count_by(d, "transaction_type", "amount",
                                                ("count", "avg_amount")),
        "row_count": row_count,
    },
    "estimated_time_of_arrival": {
        "sample": sample_rows,
        "long_trips": lambda d: sample_rows(d, F.col("estimated_distance_km") > 50),
        "weather_impact": lambda d: count_by(d, "weather", "simulated_actual_travel_time_seconds",
                                             ("trips", "avg_time")),
        "driver_performance": lambda d: count_by(d, "driver_id", "driver_rating",
                                                 ("trips", "avg_rating"), top=TOP),
        "vehicle_types": lambda d: count_by(d, "vehicle_type", "estimated_distance_km",
                                            ("count", "avg_distance")),
        "row_count": row_count,
    },
    "e_commerce_customer_interactions": {
        "sample": sample_rows,
        "purchases": lambda d: sample_rows(d, F.col("event_type") == "purchase"),
        "by_category": lambda d: count_by(d, "product_category"),
        "event_types": lambda d: count_by(d, "event_type"),
        "top_products": top_products,
        "row_count": row_count,
    },
}
