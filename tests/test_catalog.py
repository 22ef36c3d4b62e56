"""Catalog views, processing time, changelog tail, feeds,
completion delay, retention policy, late rate."""

from pyspark.sql import functions as F

from conftest import customers_df, products_df, raw_df, raw_row
from tidemark.operators import analytics as an, observe
from tidemark.operators.ingest import with_proctime
from tidemark.sources import catalog, lifecycle
from tidemark.sources.log import append_log
from tidemark.streaming import jobs


def _deployment(spark, root):
    layout = jobs.Layout(spark, root)
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "GOLD")]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "electronics")]))
    append_log(raw_df(spark, [raw_row("O1", "30000", time="2024-01-01 00:00:01"),
                              raw_row("O2", "10", time="2024-01-02 00:00:01"),
                              raw_row("O3", "10", time="2024-01-03 00:20:00")]), layout.raw_path)
    for start in (jobs.start_enrich_and_alert, jobs.start_revenue):
        q = start(layout, trigger={"availableNow": True})
        q.awaitTermination()
    return layout


def test_catalog_views_and_tail(spark, scratch):
    layout = _deployment(spark, scratch)
    names = catalog.register_tables(spark, scratch, database="tidemark_test")
    assert "orders_enriched" in names
    assert spark.sql("SELECT count(*) FROM orders_raw").first()[0] == 3
    assert spark.sql("SELECT customer_name FROM orders_enriched WHERE order_id = 'O1'").first()[0] == "Asha"
    assert spark.sql("SELECT reason FROM suspicious_orders").first()[0].startswith("Very high")
    # The alert changelog as a stream
    q = (layout.table("high_value_orders").tail().writeStream.format("memory")
         .queryName("hv_tail").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.order_id for r in spark.sql("SELECT order_id FROM hv_tail").collect()] == ["O1"]
    # O3: completion delay from the changelog's write times
    delay = observe.completion_delay(layout.table("revenue_5min").changes()).first()[0]
    assert delay > 0
    spark.catalog.setCurrentDatabase("default")


def test_retention_policy_over_a_deployment(spark, scratch):
    layout = _deployment(spark, scratch)
    done = lifecycle.apply_policy(spark, scratch, "20240103", {"orders_raw": 1, "orders_enriched": 1})
    assert done["orders_raw"] == ["20240101"]
    days = {r.event_day for r in layout.table("orders_enriched").read_current().collect()}
    assert days == {"20240102", "20240103"}


def test_proctime_and_feeds(spark):
    raw = raw_df(spark, [raw_row(f"O{i}", "10", time=f"2024-01-01 00:00:0{i}") for i in range(5)])
    assert "ptime" in with_proctime(raw).columns
    e = raw.withColumn("customer_name", F.lit("x")).withColumn("product_name", F.lit("p")) \
           .withColumn("category", F.lit("c")).withColumn("loyalty_tier", F.lit("GOLD"))
    got = [r.order_id for r in an.feed(e, "orders").collect()]
    assert got == ["O4", "O3", "O2", "O1", "O0"]


def test_late_rate(spark):
    raw = raw_df(spark, [raw_row("1", "1", time="2024-01-01 00:01:00"),
                         raw_row("2", "1", time="2024-01-01 00:02:00")])
    pub = spark.createDataFrame([], "window_start timestamp, city string, total_orders long") \
        .unionByName(spark.createDataFrame([(None, "Mumbai", 1)], "window_start timestamp, city string, total_orders long"))
    r = observe.late_rate(raw, pub.where(F.col("window_start").isNotNull()), key="city").first()
    assert (r.late_rows, r.total_rows, r.late_rate) == (2, 2, 1.0)


def test_dashboard_panels_over_stored_tables(spark, scratch):
    from tidemark.plans.dashboard import panels
    layout = _deployment(spark, scratch)
    q = jobs.start_kpis(layout, trigger={"availableNow": True})
    q.awaitTermination()
    p = panels(layout)
    assert len(p) == 16
    counts = {r.table_name: r.row_count for r in p["alert_counts"].collect()}
    assert counts == {"high_value_orders": 1, "suspicious_orders": 1}
    assert p["kpis"].count() == 5
    assert [r.order_id for r in p["latest_orders"].collect()] == ["O3", "O2", "O1"]


def test_dashboard_refresh_in_parallel(spark, scratch):
    from tidemark.plans.dashboard import refresh
    layout = _deployment(spark, scratch)
    out = refresh(layout, workers=4)
    assert len(out) == 16 and [r.order_id for r in out["latest_orders"]] == ["O3", "O2", "O1"]


def test_dashboard_timeline_is_recent_only(spark, scratch):
    from tidemark.plans.dashboard import panels
    layout = _deployment(spark, scratch)
    # windows exist for Jan 1 and Jan 2 (Jan 3's window is still open at the end of the stream)
    rows = panels(layout, "2024-01-02 12:00:00", timeline_hours=24)["timeline"].collect()
    assert rows and all(r.window_start.day == 2 for r in rows)
