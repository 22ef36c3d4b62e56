"""Generator rows -> orders_raw (day key, typed amount, millisecond event time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import day_key

RAW_COLUMNS = ["event_day", "order_id", "customer_id", "product_id", "order_amount", "quantity",
               "payment_status", "order_status", "payment_method", "device_type", "city",
               "event_time"]


def ms_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Truncate to milliseconds (TIMESTAMP(3)), keeping the column's own timestamp flavour."""
    kind = df.schema[column].dataType
    truncated = F.date_trunc("MILLISECOND", F.col(column))
    if isinstance(kind, T.TimestampNTZType):
        truncated = truncated.cast("timestamp_ntz")
    return df.withColumn(column, truncated)


def to_orders_raw(df: DataFrame) -> DataFrame:
    """Ingest projection. A malformed amount becomes NULL (``try_cast``) instead of failing the
    batch under ANSI mode; data-quality rules route such rows to the dead-letter table."""
    df = ms_time(df)
    return df.select(
        day_key("event_time").alias("event_day"), "order_id", "customer_id", "product_id",
        F.col("order_amount_str").try_cast("decimal(10,2)").alias("order_amount"),
        F.col("quantity").cast("int").alias("quantity"), "payment_status", "order_status",
        "payment_method", "device_type", "city", "event_time")


def with_proctime(df: DataFrame, column: str = "ptime") -> DataFrame:
    """Processing-time attribute (not stored; evaluated per micro-batch / query)."""
    return df.withColumn(column, F.current_timestamp())
