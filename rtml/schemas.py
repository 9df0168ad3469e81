"""Declared schemas of the event tables and the per-project feature contracts.

The column names and orders below are fixed values: they are the data contract.
"""

from __future__ import annotations

TRANSACTIONS = (
    "transaction_id string, user_id string, timestamp string, amount double, currency string, "
    "merchant_id string, product_category string, transaction_type string, payment_method string, "
    "location string, ip_address string, device_info string, user_agent string, "
    "account_age_days int, cvv_provided boolean, billing_address_match boolean, is_fraud int"
)

TRIPS = (
    "trip_id string, driver_id string, vehicle_id string, timestamp string, origin string, "
    "destination string, estimated_distance_km double, weather string, temperature_celsius double, "
    "day_of_week int, hour_of_day int, driver_rating double, vehicle_type string, "
    "initial_estimated_travel_time_seconds int, simulated_actual_travel_time_seconds int, "
    "debug_traffic_factor double, debug_weather_factor double, debug_incident_delay_seconds int, "
    "debug_driver_factor double"
)

INTERACTIONS = (
    "event_id string, customer_id string, session_id string, timestamp string, event_type string, "
    "product_id string, product_category string, price double, quantity int, page_url string, "
    "referrer_url string, device_info string, location string, session_event_sequence int, "
    "time_on_page_seconds int, search_query string"
)

DEVICE = "device_type string, browser string, os string"
LOCATION = "lat double, lon double"

TABLES = {
    "transaction_fraud_detection": TRANSACTIONS,
    "estimated_time_of_arrival": TRIPS,
    "e_commerce_customer_interactions": INTERACTIONS,
}

TIME_PARTS = ["year", "month", "day", "hour", "minute", "second"]

TFD_NUMERIC = ["amount", "account_age_days", "cvv_provided", "billing_address_match"]
TFD_CATEGORICAL = ["currency", "merchant_id", "payment_method", "product_category",
                   "transaction_type", "browser", "os", *TIME_PARTS]
TFD_TARGET = "is_fraud"

ETA_NUMERIC = ["estimated_distance_km", "temperature_celsius", "driver_rating", "hour_of_day",
               "initial_estimated_travel_time_seconds", "debug_traffic_factor",
               "debug_weather_factor", "debug_incident_delay_seconds", "debug_driver_factor"]
ETA_CATEGORICAL = ["trip_id", "driver_id", "vehicle_id", "origin", "destination", "weather",
                   "day_of_week", "vehicle_type", *TIME_PARTS]
ETA_TARGET = "simulated_actual_travel_time_seconds"

ECCI_NUMERIC = ["price", "quantity", "session_event_sequence", "time_on_page_seconds"]
ECCI_CATEGORICAL = ["event_type", "product_category", "product_id", "referrer_url", "browser",
                    "device_type", "os", *TIME_PARTS]

CUSTOMER_FEATURES = [
    "total_sessions", "total_events", "avg_time_on_page", "total_time_on_site",
    "avg_events_per_session", "total_purchases", "total_revenue", "avg_order_value", "page_views",
    "product_views", "add_to_carts", "searches", "unique_products_viewed",
    "unique_categories_viewed", "preferred_hour", "days_active", "geo_diversity",
    "view_to_cart_rate", "cart_to_purchase_rate",
]

# Metric that ranks runs, per project: (metric name, larger is better).
BEST_METRIC_BATCH = {
    "transaction_fraud_detection": ("fbeta_score", True),
    "estimated_time_of_arrival": ("MAE", False),
    "e_commerce_customer_interactions": ("silhouette_score", True),
}
BEST_METRIC_ONLINE = {
    "transaction_fraud_detection": ("FBeta", True),
    "estimated_time_of_arrival": ("MAE", False),
    "e_commerce_customer_interactions": ("Silhouette", True),
    "sales_forecasting": ("MAE", False),
}
