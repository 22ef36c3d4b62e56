"""Chained windows: batch against the single-pass forms, streams against batch."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, products_df, raw_df, raw_row
from tidemark.operators import analytics, chained, observe, windows
from tidemark.plans.frames import Tables
from tidemark.streaming import jobs


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    a, b = a.select(cols), b.select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_batch_equals_the_one_pass_forms(spark):
    t = Tables(spark, SF_SMALL)
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    same(chained.spike_alerts(raw), observe.alert_spike(raw.where(chained.any_match(chained.rules.SUSPICIOUS_RULES))))
    same(chained.failed_rate_alerts(raw), observe.alert_failed_rate(windows.revenue_by_window(raw, t.products)))
    rolled = chained.rollup(raw, "city").groupBy("city").agg(F.sum("revenue").cast("decimal(20,2)").alias("revenue"), F.sum("orders").alias("orders"))
    same(rolled, analytics.rollup_windows(windows.city_revenue_by_window(raw), "city").select("city", "revenue", "orders"))


@pytest.mark.parametrize("name", sorted(jobs.CHAINED))
def test_stream_equals_batch_for_closed_windows(spark, scratch, name):
    layout = jobs.Layout(spark, scratch)
    base, rows = dt.datetime(2024, 1, 1), []
    for i in range(400):     # steady orders, a burst of suspicious and failed ones, and a quiet hour
        minute = i * 30 / 60 if i < 240 else 200 + (i - 240) * 15 / 60
        burst = 100 <= minute <= 112
        rows.append(raw_row(f"O{i}", "30000.00" if burst or i % 9 == 0 else "100.00", status="FAILED" if burst or i % 5 == 0 else "SUCCESS",
                            time=str(base + dt.timedelta(minutes=minute)), city=["Mumbai", "Delhi"][i % 2], product=["P1", "P9"][i % 3 == 0]))
    for k in range(0, 400, 40):
        raw_df(spark, rows[k : k + 40]).coalesce(1).write.mode("append").partitionBy("event_day").parquet(layout.raw_path)
    products = products_df(spark, [("P1", "Phone", "toys")])
    layout.table("product_catalog").upsert(products)
    q = jobs.start_chained(layout, name, trigger={"availableNow": True}, max_files_per_trigger=3)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) > 2
    raw = raw_df(spark, rows).join(products.select("product_id", "category"), "product_id", "left")
    closed = raw.agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=5)
    want = jobs.CHAINED[name](raw).where(F.col("window_end") <= F.lit(closed))
    assert want.count() > 0
    same(jobs.read_emitted(layout, name), want)
