"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each builds the standard tables from the driver's parquet (plans.frames) and applies one
operator family. ``NOW`` fixes "current time" so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import alerts, analytics as an, enrich, windows
from tidemark.plans.frames import Tables

NOW = "2024-01-31 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Queries over measured times, which no SQL can foretell; tests hold them against SQL over the
#: tables that they stored.
MEASURED: set[str] = set()


def register(name: str):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# --- core tables ----------------------------------------------------------------------------

@register("orders_raw")
def _(t): return t.raw


@register("orders_enriched")
def _(t): return t.enriched


@register("enriched_unknown")
def _(t): return t.enriched_with("unknown")


@register("revenue_5min")
def _(t): return t.revenue_5min


@register("city_revenue_5min")
def _(t): return t.city_revenue_5min


@register("revenue_15min")
def _(t): return t.revenue("15 minutes")


@register("kpis_1min")
def _(t): return t.kpis_1min


@register("high_value_orders")
def _(t): return t.high_value


@register("suspicious_orders")
def _(t): return t.suspicious


# --- demo queries and panels ----------------------------------------------------------------

@register("fraud_reasons")
def _(t): return an.value_counts(t.suspicious, "reason")


@register("failed_payments")
def _(t): return alerts.failed_payments(t.enriched)


@register("latest_orders")
def _(t): return an.latest_orders(t.enriched, 50)


@register("latest_category_windows")
def _(t): return an.latest_windows(t.revenue_5min, "category", 30)


@register("latest_city_windows")
def _(t): return an.latest_windows(t.city_revenue_5min, "city", 30)


@register("revenue_by_tier")
def _(t): return an.revenue_by(t.enriched, "loyalty_tier")


@register("revenue_by_device")
def _(t): return an.revenue_by(t.enriched, "device_type")


@register("tier_ordered")
def _(t): return an.revenue_by_tier_ordered(t.enriched)


@register("top_products")
def _(t): return an.top_products(t.enriched, 15)


@register("top_products_panel")
def _(t): return an.top_products_panel(t.enriched, 15)


@register("failure_rate")
def _(t): return an.failure_rate_by(t.enriched, "payment_method")


@register("revenue_by_payment")
def _(t): return an.revenue_and_orders(t.enriched, "payment_method")


@register("inventory_risk")
def _(t): return an.inventory_risk(t.products, 100)


@register("inventory_board")
def _(t): return an.inventory_board(t.products, 50)


@register("customer_history")
def _(t): return an.customer_history(t.enriched, 20)


@register("category_rollup")
def _(t): return an.rollup_windows(t.revenue_5min, "category")


@register("city_rollup")
def _(t): return an.rollup_windows(t.city_revenue_5min, "city")


@register("payment_status_counts")
def _(t): return an.value_counts(t.enriched, "payment_status")


@register("device_counts")
def _(t): return an.value_counts(t.enriched, "device_type")


@register("city_since")
def _(t): return an.city_revenue_since(t.city_revenue_5min, "2024-01-24 00:00:00")


@register("daily_revenue")
def _(t): return an.daily_revenue(t.enriched)


@register("recent_windows")
def _(t): return an.recent_windows(t.revenue_5min, NOW, hours=6)


@register("raw_range")
def _(t): return an.between_times(t.raw, "2024-01-10 00:00:00", "2024-01-12 12:00:00")


@register("point_lookup")
def _(t): return an.point_lookup(t.enriched, order_id="ORD-0000000042")


@register("top_alerts")
def _(t): return an.top_alerts(t.high_value, 30)


@register("timeline")
def _(t): return an.timeline(t.revenue_5min)


@register("recent_raw")
def _(t): return an.recent_raw(t.raw, 100)


@register("unknown_products")
def _(t): return enrich.unknown_keys(t.raw, t.products, "product_id", t.small_products)


@register("known_products")
def _(t):
    return (enrich.known_keys(t.raw, t.products, "product_id", t.small_products)
            .groupBy("event_day").agg(F.count(F.lit(1)).alias("orders")))


for _kind, _table in {"orders": "enriched", "high_value": "high_value", "suspicious": "suspicious", "products": "products"}.items():
    register(f"feed_{_kind}")(lambda t, kind=_kind, table=_table: an.feed(getattr(t, table), kind))


@register("city_vs_category")
def _(t): return an.city_vs_category(t.revenue_5min, t.city_revenue_5min)


@register("failed_rate")
def _(t): return an.failed_rate(t.revenue_5min, "category")


@register("alert_rate")
def _(t): return an.alert_rate_of(t.enriched, "5 minutes")


@register("tier_distribution")
def _(t): return an.tier_distribution(t.customers)


@register("signup_trend")
def _(t): return an.signup_trend(t.customers)


@register("series")
def _(t): return an.series(t.revenue_5min)


# --- upsert fold, KPI board -----------------------------------------------------------------

from tidemark.functions import rules  # noqa: E402
from tidemark.operators import dedup, observe, quality  # noqa: E402
from tidemark.sources import lifecycle  # noqa: E402
from tidemark.sources.upsert import latest_per_key  # noqa: E402

REPLAYED_DAY = "20240115"
RETENTION_TODAY = "20240130"
PURGED_CUSTOMER = "CUS-00000007"


@register("kpis_latest")
def _(t):
    """The KPI upsert table — per metric_key the row of the newest window."""
    return latest_per_key(t.kpis_1min, ["metric_key"], ["updated_at"])


@register("kpi_board")
def _(t):
    """Dashboard tiles; a missing metric shows 0.0."""
    latest = latest_per_key(t.kpis_1min, ["metric_key"], ["updated_at"]) \
        .select("metric_key", "metric_value")
    counts = an.alert_counts(t.enriched).select(
        F.regexp_replace("table_name", "_orders$", "_alerts").alias("metric_key"),
        F.col("row_count").cast("double").alias("metric_value"))
    keys = [*rules.KPI_KEYS, "high_value_alerts", "suspicious_alerts"]
    board = t.spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("metric_key"))
    values = latest.unionByName(counts)
    return (board.join(values, "metric_key", "left")
            .select("metric_key", F.coalesce("metric_value", F.lit(0.0)).alias("metric_value")))


# --- de-duplication and data quality --------------------------------------------------------

@register("dedup_orders")
def _(t):
    """X11: the log plus a re-delivered day (at-least-once replay), de-duplicated by order_id."""
    replay = t.raw.where(F.col("event_day") == REPLAYED_DAY)
    return dedup.dedup_orders(t.raw.unionByName(replay), ["order_id"])


@register("dq_valid")
def _(t):
    return quality.valid_rows(quality.tag_errors(t.raw, NOW))


@register("dq_errors")
def _(t):
    return quality.error_rows(quality.tag_errors(t.raw, NOW), NOW)


@register("rejection_rate")
def _(t): return quality.rejection_rate(quality.tag_errors(t.raw, NOW))


@register("dq_rules")
def _(t):
    """Q1, Q2, Q6: orders of which some break each rule; rows and clamped quantities by rule."""
    return quality.rule_summary(quality.tag_errors(quality.broken(t.raw), NOW, "20 days"))


@register("join_miss_rate")
def _(t): return quality.join_miss_rate(t.enriched_with(flags=True))


@register("masked_orders")
def _(t): return quality.mask_pii(t.enriched)


# --- lifecycle ------------------------------------------------------------------------------

@register("retention_keep")
def _(t):
    return (lifecycle.retained(t.raw, RETENTION_TODAY, rules.RETENTION_DAYS)
            .groupBy("event_day").agg(F.count(F.lit(1)).alias("row_count")))


@register("purge_keep")
def _(t): return lifecycle.purge(t.enriched, "customer_id", PURGED_CUSTOMER)


@register("export_month")
def _(t): return lifecycle.month_slice(t.revenue_5min, "2024-01", "window_start")


# --- observability --------------------------------------------------------------------------

@register("alert_failed_rate")
def _(t): return observe.alert_failed_rate(t.revenue_5min)


@register("alert_spike")
def _(t): return observe.alert_spike(t.suspicious)


@register("input_rate")
def _(t): return observe.input_rate(t.raw, "1 minute")


@register("sustained_input")
def _(t):
    """Five-minute slots that end three in a row with two or more orders each."""
    return observe.alert_threshold(observe.input_rate(t.raw, "5 minutes"), "events", 1, 3, "5 minutes")


@register("capacity_levels")
def _(t):
    """Minutes by capacity level, for a capacity of three orders a minute."""
    load = observe.utilisation(observe.input_rate(t.raw, "1 minute"), 3 / 60)
    return observe.classify(load).groupBy("level").agg(F.count(F.lit(1)).alias("minutes"))


@register("freshness_seconds")
def _(t):
    return observe.freshness_seconds({"revenue_5min": t.revenue_5min,
                                      "city_revenue_5min": t.city_revenue_5min}, NOW)


@register("throughput_timeline")
def _(t): return observe.throughput_timeline(t.raw, "2024-01-01 00:00:00", "1 hour")


LATENCY_TRIGGER = "5 seconds"


@register("slo_report")
def _(t):
    samples = observe.ingestion_latency_samples(t.raw, LATENCY_TRIGGER)
    return observe.slo_report(samples, {"ingestion_latency": rules.SLO_BURN[0][1]})


@register("burn_rate")
def _(t):
    name, objective, fast, slow = rules.SLO_BURN[0]
    samples = observe.ingestion_latency_samples(t.raw, LATENCY_TRIGGER)
    return observe.burn_rate(samples, name, objective, fast, slow)


# --- stored tiers, streaming jobs drained with availableNow ---------------------------------

from tidemark.plans import streams, tiers  # noqa: E402

register("table_counts")(streams.table_counts)
register("lag_seconds")(lambda t: streams.lag_seconds(t, NOW))
register("invariants")(streams.invariants)
register("validate_run")(streams.validate_run)
register("union_read")(tiers.union_read)
register("cold_read")(tiers.cold_read)
register("cold_trend")(tiers.cold_trend)
register("log_range")(tiers.log_range)
register("stored_recent_windows")(lambda t: tiers.stored_recent_windows(t, NOW))
register("stored_city_since")(lambda t: tiers.stored_city_since(t, "2024-01-24 00:00:00"))
register("stored_lookup")(tiers.stored_lookup)
register("live_purge")(tiers.live_purge)

register("stream_revenue_5min")(streams.stream_revenue_5min)
register("stream_city_revenue_5min")(streams.stream_city_revenue_5min)
register("stream_alerts")(streams.stream_alerts)
register("stream_kpis")(streams.stream_kpis)
register("stream_dedup")(streams.stream_dedup)
register("stream_late_rows")(streams.stream_late_rows)
for _name in streams.jobs.CHAINED:
    register(f"stream_{_name}")(lambda t, name=_name: streams.stream_chained(t, name))
register("stream_slo_report")(streams.stream_slo_report)
register("stream_burn_rate")(streams.stream_burn_rate)
MEASURED.update(("stream_slo_report", "stream_burn_rate"))
