"""Tumbling event-time windows.

Windows are epoch-aligned and half-open ([start, end)), as ``F.window`` produces. The same
functions accept batch or streaming frames; a streaming caller adds the watermark first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import day_key
from tidemark.functions.rules import KPI_KEYS
from tidemark.operators.enrich import bounded_broadcast

def failed_flag() -> F.Column:
    return F.when(F.col("payment_status") == "FAILED", 1).otherwise(0)


def _money_sum(col: str) -> F.Column:
    # SUM(DECIMAL(10,2)) is DECIMAL(20,2); re-summing partial sums keeps that type.
    return F.sum(col).cast("decimal(20,2)")


def window_parts(w: str = "w") -> list[F.Column]:
    return [day_key(F.col(f"{w}.start")).alias("window_day"),
            F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def revenue_by_window(orders: DataFrame, products: DataFrame, width: str = "5 minutes",
                      small_products: bool | None = None) -> DataFrame:
    """A1: orders per window and product category: count, revenue, failed, average.

    When the catalog fits a broadcast, orders are joined first and one aggregate runs (the
    shuffle carries only window x category partials). When it does not, orders are first
    reduced to (window, product) partials, so the shuffled join sees windows x products rows
    instead of every order, and a second small aggregate rolls products up to categories.
    A missing product lands in the NULL category (reference behaviour).
    """
    from tidemark.operators.enrich import one_per_key
    cat = one_per_key(products, "product_id", ["category"])
    if small_products is None:
        from tidemark.operators.enrich import fits_broadcast
        small_products = fits_broadcast(cat)
    win = F.window("event_time", width).alias("w")
    if small_products:
        grouped = (orders.join(F.broadcast(cat), "product_id", "left")
                   .groupBy(win, "category")
                   .agg(F.count(F.lit(1)).alias("total_orders"),
                        _money_sum("order_amount").alias("total_revenue"),
                        F.sum(failed_flag()).alias("failed_payments")))
    else:
        partial = (orders.groupBy(win, "product_id")
                   .agg(F.count(F.lit(1)).alias("n"), _money_sum("order_amount").alias("s"),
                        F.sum(failed_flag()).alias("f")))
        grouped = (partial.join(cat, "product_id", "left").groupBy("w", "category")
                   .agg(F.sum("n").alias("total_orders"), _money_sum("s").alias("total_revenue"),
                        F.sum("f").alias("failed_payments")))
    return finish_revenue(grouped)


def finish_revenue(grouped: DataFrame) -> DataFrame:
    """(w, category, total_orders, total_revenue, failed_payments) -> revenue_5min rows."""
    return grouped.select(
        *window_parts(), "category", "total_orders", "total_revenue", "failed_payments",
        (F.col("total_revenue") / F.col("total_orders")).cast("decimal(20,2)")
        .alias("avg_order_value"))


def product_window_partials(orders: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Per (window, product) partial sums: the state a streaming A1 keeps."""
    return (orders.groupBy(F.window("event_time", width).alias("w"), "product_id")
            .agg(F.count(F.lit(1)).alias("n"), _money_sum("order_amount").alias("s"),
                 F.sum(failed_flag()).alias("f")))


def rollup_partials(partials: DataFrame, products: DataFrame,
                    small_products: bool | None = None, unique: bool = False) -> DataFrame:
    """Closed (window, product) partials + the catalog as of now -> revenue_5min rows."""
    from tidemark.operators.enrich import one_per_key
    side = products.select("product_id", "category") if unique \
        else one_per_key(products, "product_id", ["category"])
    cat = bounded_broadcast(side, small_products)
    grouped = (partials.join(cat, "product_id", "left").groupBy("w", "category")
               .agg(F.sum("n").alias("total_orders"), _money_sum("s").alias("total_revenue"),
                    F.sum("f").alias("failed_payments")))
    return finish_revenue(grouped)


def city_revenue_by_window(orders: DataFrame, width: str = "5 minutes") -> DataFrame:
    """A2: orders and revenue per window and order city."""
    return (orders.groupBy(F.window("event_time", width).alias("w"), "city")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 _money_sum("order_amount").alias("total_revenue"))
            .select(*window_parts(), "city", "total_orders", "total_revenue"))


def window_seconds(width: str) -> int:
    n, unit = width.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale


def kpis(orders: DataFrame, width: str = "1 minute") -> DataFrame:
    """A3-A7 + U1: five KPI rows per window from ONE aggregate (the reference scans five times).

    Output (metric_key, metric_value double, updated_at = window end).
    """
    agg = (orders.groupBy(F.window("event_time", width).alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("order_amount").alias("s"),
                F.sum(failed_flag()).alias("f")))
    n = F.col("n").cast("double")
    values = [n, F.col("s").cast("double"), F.col("f").cast("double"),
              F.col("s").cast("double") / F.col("n"),
              F.col("n") / F.lit(float(window_seconds(width)))]
    rows = F.array(*[F.struct(F.lit(k).alias("metric_key"), v.alias("metric_value"))
                     for k, v in zip(KPI_KEYS, values)])
    return agg.select(F.inline(rows), F.col("w.end").alias("updated_at"))
