"""The dashboard's panels over the STORED tables (what a refresh runs against a deployment).

The registered queries recompute everything from the raw events; a dashboard instead reads
the materialized upsert tables the streaming jobs maintain, as the original design does.
Every panel aggregates the whole table in Spark and returns a small result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators import analytics as an
from tidemark.streaming.jobs import Layout


def panels(layout: Layout, now=None, timeline_hours: int = 24) -> dict[str, DataFrame]:
    """All panels; each result is small by construction (top-k, grouped by a low-cardinality
    column, or — for the timeline — the windows of the last ``timeline_hours`` before ``now``,
    default the current time)."""
    t = {n: layout.table(n).read_current() for n in
         ["orders_enriched", "high_value_orders", "suspicious_orders", "revenue_5min",
          "city_revenue_5min", "dashboard_kpis", "customer_profile", "product_catalog"]}
    e = t["orders_enriched"]
    keys = [*rules.KPI_KEYS]
    board = (layout.spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("metric_key"))
             .join(t["dashboard_kpis"].select("metric_key", "metric_value"), "metric_key", "left")
             .select("metric_key", F.coalesce("metric_value", F.lit(0.0)).alias("metric_value")))
    return {
        "kpis": board,
        "alert_counts": an.table_counts({"high_value_orders": t["high_value_orders"],
                                         "suspicious_orders": t["suspicious_orders"]}),
        "category_rollup": an.rollup_windows(t["revenue_5min"], "category"),
        "city_rollup": an.rollup_windows(t["city_revenue_5min"], "city"),
        "timeline": an.timeline(an.recent_windows(
            t["revenue_5min"], now if now is not None else _dt.datetime.now(_dt.timezone.utc)
            .replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S"), timeline_hours)),
        "latest_orders": an.latest_orders(e, 50),
        "payment_status": an.value_counts(e, "payment_status"),
        "devices": an.value_counts(e, "device_type"),
        "revenue_by_payment": an.revenue_and_orders(e, "payment_method"),
        "revenue_by_tier": an.revenue_by_tier_ordered(e),
        "top_products": an.top_products_panel(e, 15),
        "high_value": an.top_alerts(t["high_value_orders"], 30),
        "suspicious": an.top_alerts(t["suspicious_orders"], 30),
        "fraud_reasons": an.value_counts(t["suspicious_orders"], "reason"),
        "customers": an.tier_distribution(t["customer_profile"]),
        "products": an.inventory_board(t["product_catalog"], 50),
    }


def refresh(layout: Layout, workers: int = 5, now=None) -> dict[str, list]:
    """Run every panel and return its (small) rows. Panels are independent Spark jobs, so they
    are submitted from ``workers`` threads on the one session and share the cluster's slots;
    an error in any panel is raised, never turned into an empty panel."""
    from concurrent.futures import ThreadPoolExecutor
    p = panels(layout, now)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(df.collect) for name, df in p.items()}
        return {name: f.result() for name, f in futures.items()}
