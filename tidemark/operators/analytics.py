"""The analytical queries a dashboard runs over the derived tables.

Every aggregate runs over the whole table inside Spark (partial + final aggregation); only
the small result leaves. Top-k uses ``orderBy(...).limit(k)`` which plans as a per-partition
top-k plus a k-row merge (TakeOrderedAndProject). Ties are broken by the group columns so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import day_key

def failed_flag() -> F.Column:
    return F.when(F.col("payment_status") == "FAILED", 1).otherwise(0)


def money_sum(col: str = "order_amount") -> F.Column:
    return F.sum(col).cast("decimal(20,2)")


def avg_money(total: str, count: str, precision: int = 10) -> F.Column:
    """CAST(SUM/COUNT AS DECIMAL(p,2)): exact decimal division, HALF_UP."""
    return (F.col(total) / F.col(count)).cast(f"decimal({precision},2)")


def ts_lit(df: DataFrame, col: str, value) -> F.Column:
    """A timestamp literal of the same flavour (ntz or zoned) as ``df[col]``."""
    return F.lit(value).cast(df.schema[col].dataType)


def _tiebreak(cols: list[str]) -> list[F.Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


# --- demo queries (batch) -------------------------------------------------------------------

def revenue_by(df: DataFrame, key: str) -> DataFrame:
    """Count, revenue and average order value per key, highest revenue first."""
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("total_orders"), money_sum().alias("total_revenue"))
            .withColumn("avg_order_value", avg_money("total_revenue", "total_orders"))
            .orderBy(F.col("total_revenue").desc(), F.col(key).asc_nulls_first()))


def top_products(df: DataFrame, n: int = 15) -> DataFrame:
    """Top n (product_name, brand, category) by revenue; units_sold is COUNT(*)."""
    keys = ["product_name", "brand", "category"]
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("units_sold"), money_sum().alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), *_tiebreak(keys)).limit(n))


def failure_rate_by(df: DataFrame, key: str = "payment_method") -> DataFrame:
    """A10: failed share in percent, DECIMAL(5,2), exact HALF_UP."""
    one = F.when(F.col("payment_status") == "FAILED", F.lit(1).cast("decimal(2,1)")) \
           .otherwise(F.lit(0).cast("decimal(2,1)"))
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum(failed_flag()).alias("failed_count"),
                 (F.sum(one) / F.count(F.lit(1)) * 100).cast("decimal(5,2)")
                 .alias("failure_rate_pct"))
            .orderBy(F.col("failure_rate_pct").desc(), F.col(key).asc_nulls_first()))


def customer_history(df: DataFrame, n: int = 20) -> DataFrame:
    """Top n (customer, order city) groups by spend."""
    keys = ["customer_id", "customer_name", "loyalty_tier", "city"]
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("total_orders"), money_sum().alias("total_spent"))
            .withColumn("avg_order_value", avg_money("total_spent", "total_orders"))
            .orderBy(F.col("total_spent").desc(), *_tiebreak(keys)).limit(n))


# --- dashboard panels -----------------------------------------------------------------------

def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table. Each count is a global aggregate (partial counts per task)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def newest_rows(tables: dict[str, DataFrame], time_col: str = "event_time") -> DataFrame:
    """Rows (table_name, row_count, newest time), each from a scan of its own table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.max(time_col).alias("newest")).select(F.lit(name).alias("table_name"), "row_count", "newest")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alert_membership() -> dict[str, F.Column]:
    """The alert tables as conditions on an order."""
    from tidemark.functions import rules
    from tidemark.functions.exprs import any_match
    return {"high_value_orders": F.col("order_amount") >= rules.HIGH_VALUE_THRESHOLD,
            "suspicious_orders": any_match(rules.SUSPICIOUS_RULES)}


def alert_counts(enriched: DataFrame) -> DataFrame:
    """Rows (table_name, row_count) of the alert tables, which are filters of the enriched
    orders, by one conditional aggregate over one scan."""
    member = alert_membership()
    row = enriched.agg(*[F.count(F.when(cond, 1)).alias(name) for name, cond in member.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.col(name).alias("row_count")) for name in member])))


def rollup_windows(windows_df: DataFrame, key: str) -> DataFrame:
    """Window table rolled up to one row per key over all windows."""
    return (windows_df.groupBy(key)
            .agg(F.sum("total_revenue").cast("decimal(20,2)").alias("revenue"),
                 F.sum("total_orders").alias("orders"))
            .orderBy(F.col("revenue").desc(), F.col(key).asc_nulls_first()))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Distribution of a column, most frequent first."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("orders").desc(), F.col(key).asc_nulls_first()))


def revenue_and_orders(df: DataFrame, key: str) -> DataFrame:
    """Revenue and COUNT(order_amount) (NULL amounts not counted) per key."""
    return (df.groupBy(key)
            .agg(money_sum().alias("revenue"), F.count("order_amount").alias("orders"))
            .orderBy(F.col("revenue").desc(), F.col(key).asc_nulls_first()))


def tier_rank() -> F.Column:
    """Business order PLATINUM > GOLD > SILVER > BRONZE; anything else after them."""
    expr = None
    for i, tier in enumerate(rules.TIER_ORDER, start=1):
        cond = F.col("loyalty_tier") == tier
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr.otherwise(len(rules.TIER_ORDER) + 1)


def revenue_by_tier_ordered(df: DataFrame) -> DataFrame:
    """A19 per tier, in business order (tier_rank is part of the result)."""
    return (revenue_and_orders(df, "loyalty_tier").withColumn("tier_rank", tier_rank())
            .orderBy("tier_rank", F.col("loyalty_tier").asc_nulls_first()))


def top_products_panel(df: DataFrame, n: int = 15) -> DataFrame:
    """Top n (product_name, category) by revenue; the NULL group (lookup miss) is kept."""
    keys = ["product_name", "category"]
    return (df.groupBy(*keys)
            .agg(money_sum().alias("revenue"), F.count("order_amount").alias("orders"))
            .orderBy(F.col("revenue").desc(), *_tiebreak(keys)).limit(n))


def city_revenue_since(city_windows: DataFrame, since) -> DataFrame:
    """Revenue and orders per city over windows starting at or after ``since``."""
    return (since_time(city_windows, ts_lit(city_windows, "window_start", since))
            .groupBy("city")
            .agg(F.sum("total_revenue").cast("decimal(20,2)").alias("total_revenue"),
                 F.sum("total_orders").alias("total_orders")))


def daily_revenue(df: DataFrame) -> DataFrame:
    """Revenue per calendar day and category."""
    return (df.groupBy(F.to_date("event_time").alias("order_date"), "category")
            .agg(F.count(F.lit(1)).alias("total_orders"), money_sum().alias("total_revenue")))


def failed_rate(rev: DataFrame, key: str | None = "category") -> DataFrame:
    """Failed payments / orders over all windows (per key, or overall when key is None)."""
    g = rev.groupBy(key) if key else rev.groupBy()
    return (g.agg(F.sum("failed_payments").alias("failed_payments"),
                  F.sum("total_orders").alias("total_orders"))
            .withColumn("failed_rate", F.col("failed_payments").cast("double")
                        / F.col("total_orders").cast("double")))


def alert_rate(alert_tables: dict[str, DataFrame], width: str = "5 minutes") -> DataFrame:
    """Alerts per window and alert table (stored tables, each read once)."""
    parts = [df.select(F.lit(name).alias("alert_type"), "event_time")
             for name, df in alert_tables.items()]
    allv = parts[0]
    for p in parts[1:]:
        allv = allv.unionByName(p)
    return _per_window(allv, width)


def alert_rate_of(enriched: DataFrame, width: str = "5 minutes") -> DataFrame:
    """A26 from the orders themselves: an order counts for each alert table it belongs to, by
    one scan."""
    kinds = F.array_compact(F.array(*[F.when(cond, name) for name, cond in alert_membership().items()]))
    return _per_window(enriched.select("event_time", F.explode(kinds).alias("alert_type")), width)


def _per_window(alerts: DataFrame, width: str) -> DataFrame:
    return (alerts.groupBy(F.window("event_time", width).alias("w"), "alert_type")
            .agg(F.count(F.lit(1)).alias("alerts"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "alert_type", "alerts"))


def tier_distribution(customers: DataFrame) -> DataFrame:
    """Customers per loyalty tier."""
    return customers.groupBy("loyalty_tier").agg(F.count(F.lit(1)).alias("customers"))


def signup_trend(customers: DataFrame) -> DataFrame:
    """Sign-ups per month."""
    return (customers.groupBy(F.trunc("signup_date", "MM").alias("signup_month"))
            .agg(F.count(F.lit(1)).alias("customers")))


def series(rev: DataFrame) -> DataFrame:
    """Per window and category, average order value and failed rate as a series."""
    return (rev.select("window_start", "category", "avg_order_value",
                       (F.col("failed_payments").cast("double")
                        / F.col("total_orders").cast("double")).alias("failed_rate"))
            .orderBy("window_start", F.col("category").asc_nulls_first()))


# --- filters and feeds ----------------------------------------------------------------------

def inventory_risk(products: DataFrame, below: int = 100) -> DataFrame:
    """products with inventory below the threshold, lowest first."""
    return (products.where(F.col("inventory_count") < below)
            .select("product_id", "product_name", "category", "brand", "inventory_count")
            .orderBy("inventory_count", "product_id"))


def inventory_board(products: DataFrame, n: int = 50, below: int = 100) -> DataFrame:
    """The n lowest-stock products with the low-stock flag of the panel."""
    return (products.select("product_id", "product_name", "category", "brand", "unit_price",
                            "inventory_count",
                            (F.col("inventory_count") < below).alias("low_stock"))
            .orderBy("inventory_count", "product_id").limit(n))


def between_times(df: DataFrame, start, end, time_col: str = "event_time",
                  day_col: str = "event_day") -> DataFrame:
    """rows with start <= time < end.

    The day-partition predicate is derived from the range, because Catalyst cannot infer
    event_day bounds from event_time bounds; with it the scan prunes whole day directories.
    """
    s, e = ts_lit(df, time_col, start), ts_lit(df, time_col, end)
    return df.where((F.col(day_col) >= day_key(s)) & (F.col(day_col) <= day_key(e))
                    & (F.col(time_col) >= s) & (F.col(time_col) < e))


def recent_windows(windows_df: DataFrame, now, hours: int = 1) -> DataFrame:
    """windows that started within the last ``hours`` before ``now`` (now is a parameter)."""
    return since_time(windows_df, ts_lit(windows_df, "window_start", now) - F.expr(f"INTERVAL {int(hours)} HOURS"))


def since_time(windows_df: DataFrame, since: F.Column) -> DataFrame:
    """Windows from a time on; their day is bounded, too, so that a stored table's scan prunes."""
    return windows_df.where((F.col("window_day") >= day_key(since)) & (F.col("window_start") >= since))


def point_lookup(df: DataFrame, **key) -> DataFrame:
    """Rows equal on every given key column (pushed down to the parquet scan)."""
    cond = None
    for col, value in key.items():
        c = F.col(col) == F.lit(value)
        cond = c if cond is None else cond & c
    return df.where(cond)


LATEST_ORDER_COLUMNS = ["order_id", "customer_name", "product_name", "category", "city",
                        "order_amount", "payment_status", "payment_method", "device_type",
                        "loyalty_tier", "event_time"]


def latest_orders(enriched: DataFrame, n: int = 50) -> DataFrame:
    """The n most recent orders over the whole table (not a sample)."""
    return (enriched.select(*LATEST_ORDER_COLUMNS)
            .orderBy(F.col("event_time").desc(), "order_id").limit(n))


def latest_windows(windows_df: DataFrame, key: str, n: int = 30) -> DataFrame:
    """ORDER BY window_end DESC, total_revenue DESC (then key) LIMIT n."""
    cols = ["window_start", "window_end", key, "total_orders", "total_revenue"]
    if key == "category":
        cols += ["failed_payments", "avg_order_value"]
    return (windows_df.select(*cols)
            .orderBy(F.col("window_end").desc(), F.col("total_revenue").desc(),
                     F.col(key).asc_nulls_first()).limit(n))


def top_alerts(alerts_df: DataFrame, n: int = 30) -> DataFrame:
    """T5: alerts by amount, highest first."""
    return alerts_df.orderBy(F.col("order_amount").desc(), "order_id").limit(n)


def timeline(rev: DataFrame) -> DataFrame:
    """Revenue windows in window_start order."""
    return (rev.select("window_start", "category", "total_revenue")
            .orderBy("window_start", F.col("category").asc_nulls_first()))


def recent_raw(raw: DataFrame, n: int = 100) -> DataFrame:
    """ORDER BY event_time DESC LIMIT n over the raw log."""
    return raw.orderBy(F.col("event_time").desc(), "order_id").limit(n)


def oldest_windows(windows_df: DataFrame, n: int = 100) -> DataFrame:
    """ORDER BY window_start ASC LIMIT n (used on the cold tier)."""
    return windows_df.orderBy("window_start", F.col("category").asc_nulls_first()).limit(n)


def city_vs_category(rev: DataFrame, city_rev: DataFrame) -> DataFrame:
    """Each city's revenue against its window's category totals.

    The category side is first reduced to one row per window, so the join is one-to-one per
    (window, city) and never emits category x city pairs.
    """
    per_window = (rev.groupBy("window_start", "window_end")
                  .agg(F.sum("total_revenue").cast("decimal(20,2)").alias("window_revenue"),
                       F.sum("total_orders").alias("window_orders"),
                       F.count(F.lit(1)).alias("categories")))
    return (city_rev.select("window_start", "window_end", "city",
                            F.col("total_revenue").alias("city_revenue"),
                            F.col("total_orders").alias("city_orders"))
            .join(per_window, ["window_start", "window_end"], "inner")
            .withColumn("city_share", F.col("city_revenue").cast("double")
                        / F.col("window_revenue").cast("double")))


FEEDS = {
    # The dashboard's column subsets with their sample sizes
    "orders": (LATEST_ORDER_COLUMNS, 500),
    "high_value": (["order_id", "customer_name", "loyalty_tier", "category", "city",
                    "order_amount", "event_time"], 30),
    "suspicious": (["order_id", "customer_id", "order_amount", "payment_status", "payment_method",
                    "device_type", "city", "reason", "event_time"], 30),
    "products": (["product_id", "product_name", "category", "brand", "unit_price",
                  "inventory_count"], 50),
}


def feed(df: DataFrame, kind: str, order_by: list | None = None) -> DataFrame:
    """A column-subset sample. A LIMIT sample is the feature here; an ordering makes
    it deterministic (newest first when the table has event_time)."""
    cols, n = FEEDS[kind]
    if order_by is None:
        order_by = [F.col("event_time").desc(), "order_id"] if "event_time" in cols else cols[:1]
    return df.select(*cols).orderBy(*order_by).limit(n)
