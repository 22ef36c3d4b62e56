"""Adapter from the driver's tables (events, part, customer) to the order model.

The driver ships TPC-H-like tables plus an ``events`` stream; this module maps them, with
plain column expressions, onto generator rows, ``product_catalog`` and ``customer_profile``.
The mapping is deterministic, so the DuckDB oracle (plans.oracle) repeats it in SQL.
The dimensions are read whole; lookup misses come from orders that refer to an id which no
dimension has (every 97th event's product, every 53rd event's customer).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import slot_pick
from tidemark.operators.ingest import to_orders_raw

# Adapter parameters (ours, not the reference's).
ORDERS_PER_PRODUCT = 5     # the driver's tables hold 5 events per part: event_id div 5 spans
                           # every part key at every scale, so orders cover the whole catalog
PRODUCT_MISS = 97          # events with event_id % 97 = 0 refer to an unknown product
CUSTOMER_MISS = 53         # events with event_id % 53 = 0 refer to an unknown customer
AMOUNT_FACTOR = Decimal("2.5")
SIGNUP_BASE = "2023-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded(prefix: str, num, width: int) -> F.Column:
    """Zero-padded to ``width`` digits; longer numbers keep all of theirs."""
    return F.when(num.isNotNull(), F.format_string(f"{prefix}%0{width}d", num.cast("bigint")))


def product_key(num) -> F.Column:
    return padded("SKU-", num, 6)


def customer_key(num) -> F.Column:
    return padded("CUS-", num, 8)


def events_as_orders(events: DataFrame) -> DataFrame:
    """events -> generator-shaped rows (amount as text, like the generator's output)."""
    eid = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint")
    amount = (cents.cast("decimal(10,0)") * F.lit(AMOUNT_FACTOR)).cast("decimal(10,2)")
    return events.select(
        padded("ORD-", eid, 10).alias("order_id"),
        F.when(eid % CUSTOMER_MISS == 0, padded("CUS-X", F.col("user_id"), 8))
        .otherwise(customer_key(F.col("user_id"))).alias("customer_id"),
        F.when(eid % PRODUCT_MISS == 0, padded("SKU-X", F.expr(f"event_id div {ORDERS_PER_PRODUCT}"), 6))
        .otherwise(product_key(F.expr(f"event_id div {ORDERS_PER_PRODUCT}"))).alias("product_id"),
        amount.cast("string").alias("order_amount_str"),
        (F.lit(1) + eid % 3).cast("int").alias("quantity"),
        slot_pick(eid % 12, rules.PAYMENT_STATUS).alias("payment_status"),
        slot_pick(F.expr("event_id div 5") % 10, rules.ORDER_STATUS).alias("order_status"),
        slot_pick(F.expr("event_id div 7") % 20, rules.PAYMENT_METHOD).alias("payment_method"),
        slot_pick(F.expr("event_id div 12") % 10, rules.DEVICE_TYPE).alias("device_type"),
        slot_pick(F.expr("event_id div 3") % 20, rules.ORDER_CITY).alias("city"),
        F.col("ts").alias("event_time"))


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_orders_raw(events_as_orders(read_table(spark, sf_dir, "events")))


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return (part
            .select(product_key(F.col("p_partkey")).alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
                    (F.col("p_size") * 10).cast("int").alias("inventory_count"),
                    F.lit(rules.PRODUCT_UPDATED_AT).cast("timestamp_ntz").alias("updated_at")))


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    signup = F.date_add(F.lit(SIGNUP_BASE).cast("date"), (key % 365).cast("int"))
    return (cust
            .select(customer_key(key).alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    slot_pick(key % 20, rules.ORDER_CITY).alias("city"),
                    slot_pick(key % 10, [("BRONZE", 4), ("SILVER", 3), ("GOLD", 2),
                                         ("PLATINUM", 1)]).alias("loyalty_tier"),
                    signup.alias("signup_date"),
                    F.to_timestamp_ntz(F.concat(signup.cast("string"), F.lit(" "),
                                                F.lit(rules.CUSTOMER_UPDATED_TIME))
                                       ).alias("updated_at")))
