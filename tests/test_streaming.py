"""FIXTURES 5.4 / 5.6 and SURVEY §5 layers 3-6: streams equal batch, lateness, dimension
changes, restart from a checkpoint."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, customers_df, products_df, raw_df, raw_row, ts
from tidemark.operators import enrich, windows
from tidemark.plans.frames import Tables
from tidemark.streaming import jobs

NOW = {"availableNow": True}


def _append(layout, spark, rows):
    raw_df(spark, rows).coalesce(1).write.mode("append").partitionBy("event_day").parquet(layout.raw_path)


def _seed(layout, spark, tier="GOLD"):
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", tier)]))
    layout.table("product_catalog").upsert(products_df(spark, [("P1", "Phone", "electronics")]))


def _drain(q):
    q.awaitTermination()
    assert q.exception() is None


def test_lateness_sequence(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    steps = [["00:04:39"], ["00:05:04", "00:04:40"], ["00:06:00"], ["00:07:00"], ["00:04:59"],
             ["00:20:00"]]
    n = 0
    windows_after = []
    for step in steps:
        _append(layout, spark, [raw_row(f"O{n + i}", "1.00", time=f"2024-01-01 {t}")
                                for i, t in enumerate(step)])
        n += len(step)
        _drain(jobs.start_revenue(layout, trigger=NOW))      # restart from the checkpoint each step
        windows_after.append({r.window_start.strftime("%H:%M"): r.total_orders
                              for r in layout.table("revenue_5min").read_current().collect()})
    assert windows_after[3]["00:00"] == 2
    assert windows_after[4]["00:00"] == 2          # 00:04:59 arrived after the window closed
    assert windows_after[5]["00:05"] == 3
    assert "00:20" not in windows_after[5]         # still open at the end of the stream
    assert spark.read.parquet(layout.raw_path).count() == 7                        # the late row stays in the raw log


def test_stream_equals_batch_for_closed_windows(spark, scratch):
    t = Tables(spark, SF_SMALL)
    layout = jobs.Layout(spark, scratch)
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    # several files, written in time order, drained in several micro-batches
    for day in sorted(r[0] for r in raw.select("event_day").distinct().collect()):
        raw.where(F.col("event_day") == day).coalesce(1).write.mode("append") \
           .partitionBy("event_day").parquet(layout.raw_path)
    layout.table("product_catalog").upsert(t.products)
    _drain(jobs.start_revenue(layout, trigger=NOW, max_files_per_trigger=7))
    got = layout.table("revenue_5min").read_current()
    closed = raw.agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=5)
    want = windows.revenue_by_window(raw, t.products).where(F.col("window_end") <= F.lit(closed))
    cols = want.columns
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0


def test_dimension_change_mid_stream(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark, "GOLD")
    _append(layout, spark, [raw_row("O1", "1.00", time="2024-01-01 00:00:01")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "PLATINUM")]))
    _append(layout, spark, [raw_row("O2", "1.00", time="2024-01-01 00:00:02")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))
    tiers = {r.order_id: r.loyalty_tier for r in layout.table("orders_enriched").read_current().collect()}
    assert tiers == {"O1": "GOLD", "O2": "PLATINUM"}
    # a rebuild from raw with the current dimensions re-enriches history
    jobs.rebuild(layout, "2024-01-01 00:00:00", "2024-01-01 00:05:00")
    tiers = {r.order_id: r.loyalty_tier for r in layout.table("orders_enriched").read_current().collect()}
    assert tiers == {"O1": "PLATINUM", "O2": "PLATINUM"}
    assert layout.table("revenue_5min").read_current().first().total_orders == 2


def test_restart_and_replay_keep_results(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    _append(layout, spark, [raw_row("O1", "30000.00", time="2024-01-01 00:00:01")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))
    _append(layout, spark, [raw_row("O2", "13000.00", status="FAILED", time="2024-01-01 00:00:02")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))     # restart from the checkpoint
    hv = layout.table("high_value_orders")
    first = sorted(r.order_id for r in hv.read_current().collect())
    assert first == ["O1", "O2"]
    # replay of batch 1 (what a restart after a failed commit does) changes nothing
    epoch = jobs.epochs_of(hv, layout.checkpoint("enrich_alert"))[-1]   # the second run's epoch
    batch = raw_df(spark, [raw_row("O2", "13000.00", status="FAILED", time="2024-01-01 00:00:02")])
    e = enrich.enrich(batch, layout.table("customer_profile").read_current(),
                      layout.table("product_catalog").read_current())
    from tidemark.operators import alerts
    hv.write_batch(alerts.high_value(e), epoch, 1)
    assert sorted(r.order_id for r in hv.read_current().collect()) == first
    reasons = {r.order_id: r.reason for r in layout.table("suspicious_orders").read_current().collect()}
    assert reasons == {"O1": "Very high order amount exceeds 25K INR",
                       "O2": "Failed payment on high-value order"}


def test_kpi_stream(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _append(layout, spark, [raw_row("O1", "1.00", time="2024-01-01 00:00:00"),
                            raw_row("O2", "2.01", status="FAILED", time="2024-01-01 00:04:59.999"),
                            raw_row("O3", "5.00", time="2024-01-01 00:05:00"),
                            raw_row("O4", "1.00", time="2024-01-01 00:20:00")])
    _drain(jobs.start_kpis(layout, trigger=NOW))
    got = {r.metric_key: (r.metric_value, r.updated_at) for r in layout.table("dashboard_kpis").read_current().collect()}
    assert got["total_revenue_1min"] == (5.0, ts("2024-01-01 00:06:00"))
    assert len(got) == 5


def test_generator_load_into_log(spark, scratch):
    from tidemark.sources import generate
    layout = jobs.Layout(spark, scratch)
    generate.load(spark, layout.raw_path, layout.checkpoint("ingest"), rows_per_second=200,
                  seconds=8, today="2025-01-01")
    raw = spark.read.schema(jobs.schemas.ORDERS_RAW).parquet(layout.raw_path)
    n = raw.count()
    assert n > 0
    assert raw.where(F.col("order_amount").isNull()).count() == 0
    assert raw.select(F.countDistinct("order_id")).first()[0] == n


def test_start_all_topology(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    _append(layout, spark, [raw_row("O1", "30000", time="2024-01-01 00:00:01"),
                            raw_row("O2", "10", status="FAILED", time="2024-01-01 00:01:01"),
                            raw_row("O3", "10", time="2024-01-01 00:20:00")])
    qs = jobs.start_all(layout, trigger={"processingTime": "1 second"})
    try:
        for q in qs:
            q.processAllAvailable()
            q.processAllAvailable()   # a second pass lets closed windows leave the state
    finally:
        for q in qs:
            q.stop()
    assert {r.order_id for r in layout.table("orders_enriched").read_current().collect()} == {"O1", "O2", "O3"}
    assert [r.order_id for r in layout.table("high_value_orders").read_current().collect()] == ["O1"]
    assert layout.table("revenue_5min").read_current().where("total_orders = 2").count() == 1
    assert layout.table("city_revenue_5min").read_current().count() >= 1
    assert layout.table("dashboard_kpis").read_current().count() == 5


def test_progress_timeline(spark, scratch):
    from tidemark.operators import observe
    layout = jobs.Layout(spark, scratch)
    for i in range(3):
        _append(layout, spark, [raw_row(f"O{i}-{j}", "1", time=f"2024-01-01 00:0{i}:0{j}") for j in range(4)])
    q = jobs.start_kpis(layout, trigger=NOW, max_files_per_trigger=1)
    _drain(q)
    prog = observe.progress_frame(spark, q)
    assert prog.agg(F.sum("input_rows")).first()[0] == 12
    tl = observe.throughput_timeline(prog, "2000-01-01 00:00:00", "1 hour", time_col="ts",
                                     weight_col="input_rows").collect()
    assert sum(r.records for r in tl) == 12


def test_lookup_miss_to_dead_letter(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    _append(layout, spark, [raw_row("O1", "1.00", time="2024-01-01 00:00:01"),
                            raw_row("O2", "1.00", customer="NOPE", time="2024-01-01 00:00:02")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW, on_miss="dlq"))
    assert [r.order_id for r in layout.table("orders_enriched").read_current().collect()] == ["O1"]
    err = spark.read.parquet(layout.errors_path).collect()
    assert [(e.original_order_id, e.error_type) for e in err] == [("O2", "UNKNOWN_CUSTOMER")]


def test_stream_dedup_drops_redelivered_orders(spark, scratch):
    for dedup, expected in ((None, "10.00"), ("1 hour", "30000.00")):
        layout = jobs.Layout(spark, f"{scratch}/{dedup or 'none'}".replace(" ", "_"))
        _seed(layout, spark)
        _append(layout, spark, [raw_row("O1", "30000", time="2024-01-01 00:00:01")])
        _drain(jobs.start_enrich_and_alert(layout, trigger=NOW, dedup_within=dedup))
        _append(layout, spark, [raw_row("O1", "10", time="2024-01-01 00:00:02")])   # replay
        _drain(jobs.start_enrich_and_alert(layout, trigger=NOW, dedup_within=dedup))
        got = [str(r.order_amount) for r in layout.table("orders_enriched").read_current().collect()]
        assert got == [expected]


def test_validation_and_lookup_errors_share_one_layout(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    import datetime as _dt
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    fresh = now.strftime("%Y-%m-%d %H:%M:%S")
    _append(layout, spark, [raw_row("good", "5", time=fresh),
                            raw_row("bad", "0", time=fresh),
                            raw_row("miss", "5", customer="NOPE", time=fresh)])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW, on_miss="dlq", validate_now=True))
    err = {(r.original_order_id, r.error_type, r.kind) for r in spark.read.parquet(layout.errors_path).collect()}
    assert err == {("bad", "INVALID_AMOUNT", "validation"), ("miss", "UNKNOWN_CUSTOMER", "lookup")}
    assert [r.order_id for r in layout.table("orders_enriched").read_current().collect()] == ["good"]


def test_restart_after_rebuild_keeps_newer_stream_writes(spark, scratch):
    layout = jobs.Layout(spark, scratch)
    _seed(layout, spark)
    _append(layout, spark, [raw_row("O1", "1.00", time="2024-01-01 00:00:01")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "SILVER")]))
    jobs.rebuild(layout, "2024-01-01 00:00:00", "2024-01-01 00:05:00", windows_too=False)
    layout.table("orders_enriched").compact()
    layout.table("customer_profile").upsert(customers_df(spark, [("C1", "Asha", "PLATINUM")]))
    _append(layout, spark, [raw_row("O2", "1.00", time="2024-01-01 00:00:02")])
    _drain(jobs.start_enrich_and_alert(layout, trigger=NOW))      # restart on the old checkpoint
    tiers = {r.order_id: r.loyalty_tier for r in layout.table("orders_enriched").read_current().collect()}
    assert tiers == {"O1": "SILVER", "O2": "PLATINUM"}
