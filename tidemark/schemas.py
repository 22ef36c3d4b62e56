"""Declared schemas of the tables. Never inferred: streams and pruned/empty directories need them."""

from pyspark.sql import types as T

S, I, L, D, TS, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.TimestampType(), T.DateType())
MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(20, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS_RAW = _schema(
    ("event_day", S), ("order_id", S), ("customer_id", S), ("product_id", S),
    ("order_amount", MONEY), ("quantity", I), ("payment_status", S), ("order_status", S),
    ("payment_method", S), ("device_type", S), ("city", S), ("event_time", TS))

# Generator rows before ingest: amount still a string (see operators.ingest.to_orders_raw).
FAKE_ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("product_id", S), ("order_amount_str", S),
    ("quantity", I), ("payment_status", S), ("order_status", S), ("payment_method", S),
    ("device_type", S), ("city", S), ("event_time", TS))

CUSTOMER_PROFILE = _schema(
    ("customer_id", S), ("customer_name", S), ("city", S), ("loyalty_tier", S),
    ("signup_date", DT), ("updated_at", TS))

PRODUCT_CATALOG = _schema(
    ("product_id", S), ("product_name", S), ("category", S), ("brand", S),
    ("unit_price", MONEY), ("inventory_count", I), ("updated_at", TS))

ORDERS_ENRICHED = _schema(
    ("event_day", S), ("order_id", S), ("customer_id", S), ("customer_name", S),
    ("loyalty_tier", S), ("product_id", S), ("product_name", S), ("brand", S), ("category", S),
    ("city", S), ("order_amount", MONEY), ("quantity", I), ("payment_status", S),
    ("order_status", S), ("payment_method", S), ("device_type", S), ("event_time", TS))

REVENUE_5MIN = _schema(
    ("window_day", S), ("window_start", TS), ("window_end", TS), ("category", S),
    ("total_orders", L), ("total_revenue", MONEY_SUM), ("failed_payments", L),
    ("avg_order_value", MONEY_SUM))

CITY_REVENUE_5MIN = _schema(
    ("window_day", S), ("window_start", TS), ("window_end", TS), ("city", S),
    ("total_orders", L), ("total_revenue", MONEY_SUM))

HIGH_VALUE_ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("customer_name", S), ("loyalty_tier", S),
    ("order_amount", MONEY), ("city", S), ("category", S), ("event_time", TS))

SUSPICIOUS_ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_amount", MONEY), ("payment_status", S),
    ("payment_method", S), ("device_type", S), ("city", S), ("reason", S), ("event_time", TS))

DASHBOARD_KPIS = _schema(("metric_key", S), ("metric_value", D), ("updated_at", TS))

ERROR_EVENTS = _schema(
    ("original_order_id", S), ("error_type", S), ("error_message", S), ("raw_payload", S),
    ("failed_at", TS))

# Keys of the upsert tables (primary keys of the reference DDL, not enforced by storage).
KEYS = {
    "customer_profile": ["customer_id"],
    "product_catalog": ["product_id"],
    "orders_enriched": ["event_day", "order_id"],
    "revenue_5min": ["window_day", "window_start", "window_end", "category"],
    "city_revenue_5min": ["window_day", "window_start", "window_end", "city"],
    "high_value_orders": ["order_id"],
    "suspicious_orders": ["order_id"],
    "dashboard_kpis": ["metric_key"],
}

SCHEMAS = {
    "orders_raw": ORDERS_RAW, "customer_profile": CUSTOMER_PROFILE,
    "product_catalog": PRODUCT_CATALOG, "orders_enriched": ORDERS_ENRICHED,
    "revenue_5min": REVENUE_5MIN, "city_revenue_5min": CITY_REVENUE_5MIN,
    "high_value_orders": HIGH_VALUE_ORDERS, "suspicious_orders": SUSPICIOUS_ORDERS,
    "dashboard_kpis": DASHBOARD_KPIS, "error_events": ERROR_EVENTS,
}

# Day partition column of the partitioned tables.
PARTITION = {"orders_raw": "event_day", "orders_enriched": "event_day",
             "revenue_5min": "window_day", "city_revenue_5min": "window_day"}
