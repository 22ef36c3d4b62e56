"""A14, A15, A26, O6, O7 as chained event-time aggregates, the same on batches and streams.

A first aggregate counts tumbling windows; ``window_time`` gives each of its rows an event time,
and a second aggregate groups these rows by wider or by sliding windows. In a stream both keep
state in one query: the second one's windows are emitted, once, when the watermark has passed
them. Conditions over neighbouring windows (a rate that lasts, a count against the windows
before) are sliding windows over window rows, so that no ordered series is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import any_match
from tidemark.operators.windows import failed_flag, window_seconds


def _first(df: DataFrame, width: str, *keys: str, **sums: Column) -> DataFrame:
    """Tumbling windows: columns w, keys, sums, and ``at``, the window's event time."""
    rows = df.groupBy(F.window("event_time", width).alias("w"), *keys).agg(*[c.alias(n) for n, c in sums.items()])
    return rows.withColumn("at", F.window_time("w"))


def _sliding(rows: DataFrame, width: str, windows: int) -> DataFrame:
    """``rows`` of ``_first``, in each of the ``windows`` spans that end with this or a later window."""
    seconds = window_seconds(width)
    return rows.withColumn("s", F.window("at", f"{seconds * windows} seconds", f"{seconds} seconds"))


def _own(value: Column) -> Column:
    """Of a sliding span: the value of the window that it ends with."""
    return F.max(F.when(F.col("w.end") == F.col("s.end"), value))


def rollup(orders: DataFrame, key: str, width: str = "5 minutes", wide: str = "1 hour") -> DataFrame:
    """Revenue and orders by key in wide windows, from the narrow windows' sums."""
    rows = _first(orders, width, key, n=F.count(F.lit(1)), total=F.sum("order_amount").cast("decimal(20,2)"))
    return (rows.groupBy(F.window("at", wide).alias("s"), key)
            .agg(F.sum("total").cast("decimal(20,2)").alias("revenue"), F.sum("n").alias("orders"), F.count(F.lit(1)).alias("windows"))
            .select(F.col("s.start").alias("window_start"), F.col("s.end").alias("window_end"), key, "revenue", "orders", "windows"))


def alert_rate(orders: DataFrame, width: str = "1 minute", wide: str = "5 minutes") -> DataFrame:
    """High-value and suspicious orders by wide window, and the most in one narrow window."""
    kinds = F.array(F.when(F.col("order_amount") >= rules.HIGH_VALUE_THRESHOLD, "high_value_orders"),
                    F.when(any_match(rules.SUSPICIOUS_RULES), "suspicious_orders"))
    alerts = orders.select("event_time", F.explode(F.array_compact(kinds)).alias("alert_type"))
    rows = _first(alerts, width, "alert_type", n=F.count(F.lit(1)))
    return (rows.groupBy(F.window("at", wide).alias("s"), "alert_type").agg(F.sum("n").alias("alerts"), F.max("n").alias("most"))
            .select(F.col("s.start").alias("window_start"), F.col("s.end").alias("window_end"), "alert_type", "alerts", "most"))


def failed_rate_alerts(orders: DataFrame, threshold: float = rules.FAILED_RATE_ALERT,
                       windows: int = rules.FAILED_RATE_ALERT_WINDOWS, width: str = "5 minutes") -> DataFrame:
    """Windows that end a run of ``windows`` windows whose failed rate is over the threshold."""
    rows = _first(orders, width, n=F.count(F.lit(1)), failed=F.sum(failed_flag()))
    rate = F.col("failed").cast("double") / F.col("n")
    runs = (_sliding(rows.select("w", "at", rate.alias("rate")), width, windows).groupBy("s")
            .agg(F.count_if(F.col("rate") > threshold).alias("run"), _own(F.col("w.start")).alias("window_start"), _own(F.col("rate")).alias("failed_rate")))
    return runs.where(F.col("run") == windows).select("window_start", F.col("s.end").alias("window_end"), "failed_rate")


def spike_alerts(orders: DataFrame, factor: float = rules.SPIKE_FACTOR,
                 baseline_windows: int = rules.SPIKE_BASELINE_WINDOWS, width: str = "5 minutes") -> DataFrame:
    """Windows with more than ``factor`` times the suspicious orders of the windows before
    them, on average (empty ones count as 0; a zero baseline never fires)."""
    rows = _first(orders.where(any_match(rules.SUSPICIOUS_RULES)), width, alerts=F.count(F.lit(1)))
    own = F.col("w.end") == F.col("s.end")
    spans = (_sliding(rows, width, baseline_windows + 1).groupBy("s")
             .agg(F.max(F.when(own, F.col("w.start"))).alias("window_start"), F.sum(F.when(own, F.col("alerts"))).alias("alerts"),
                  F.sum(F.when(~own, F.col("alerts"))).alias("history")))
    return (spans.select("window_start", F.col("s.end").alias("window_end"), "alerts", (F.col("history") / F.lit(float(baseline_windows))).alias("baseline"))
            .where((F.col("baseline") > 0) & (F.col("alerts") > F.lit(factor) * F.col("baseline"))))
