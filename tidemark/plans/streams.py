"""Registered queries that run the streaming jobs (availableNow) over the driver's data.

The adapter's orders are written as an append log (one file per day) and the dimensions are
loaded into upsert tables, all below the shared checkpoint root; then a streaming job drains
the log and the resulting upsert table is returned. Windows still open at the end of the
stream (end later than the final watermark) are, by design, not emitted yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import rules
from tidemark.operators import analytics as an, observe, quality
from tidemark.plans.frames import Tables
from tidemark.session import scratch_dir
from tidemark.sources.log import DEFAULT_ROWS_PER_FILE, append_log, read_log
from tidemark.streaming import jobs, lateness, telemetry


def _layout(t: Tables, customers: bool = True, products: bool = True) -> jobs.Layout:
    """A fresh deployment holding the adapter's orders as a log, plus the dimensions the job
    reads (only those)."""
    layout = jobs.Layout(t.spark, scratch_dir(t.spark, "stream"))
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    append_log(raw, layout.raw_path, rows_per_file=DEFAULT_ROWS_PER_FILE)
    if customers:
        layout.table("customer_profile").upsert(t.customers)
    if products:
        layout.table("product_catalog").upsert(t.products)
    return layout


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def _ntz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def stream_revenue_5min(t: Tables) -> DataFrame:
    layout = _layout(t, customers=False)
    _drain(jobs.start_revenue(layout, trigger={"availableNow": True}))
    return _ntz(layout.table("revenue_5min").read_current())


def stream_city_revenue_5min(t: Tables) -> DataFrame:
    layout = _layout(t, customers=False, products=False)
    _drain(jobs.start_city_revenue(layout, trigger={"availableNow": True}))
    return _ntz(layout.table("city_revenue_5min").read_current())


def stream_alerts(t: Tables) -> DataFrame:
    layout = _layout(t)
    _drain(jobs.start_enrich_and_alert(layout, trigger={"availableNow": True}))
    hv = layout.table("high_value_orders").read_current()
    su = layout.table("suspicious_orders").read_current()
    cols = ["order_id", "customer_id", "order_amount", "city", "event_time"]
    out = (hv.select(F.lit("high_value").alias("alert_type"), *cols, F.lit(None).cast("string").alias("reason"))
           .unionByName(su.select(F.lit("suspicious").alias("alert_type"), *cols, "reason")))
    return _ntz(out)


ORDER_TABLES = ["orders_raw", "orders_enriched", "high_value_orders", "suspicious_orders"]


def stored_orders(t: Tables) -> dict[str, DataFrame]:
    """The log and the tables that the enrichment job has stored from it."""
    layout = _layout(t)
    _drain(jobs.start_enrich_and_alert(layout, trigger={"availableNow": True}))
    log = read_log(t.spark, layout.raw_path)
    return {name: log if name == "orders_raw" else layout.table(name).read_current() for name in ORDER_TABLES}


def table_counts(t: Tables) -> DataFrame:
    """Rows of each stored table, counted by itself."""
    return an.table_counts({**stored_orders(t), "customer_profile": t.customers, "product_catalog": t.products})


def lag_seconds(t: Tables, now: str) -> DataFrame:
    """O1: lag of each stored table."""
    return observe.lag_of(an.newest_rows(stored_orders(t)), now)


def validate_run(t: Tables) -> DataFrame:
    """Checks of a load run, from the rows of the stored tables."""
    return run_checks(stored_orders(t))


def invariants(t: Tables) -> DataFrame:
    """Q11: acceptance checks of the stored tables, each read by itself."""
    tables = stored_orders(t)
    return quality.invariants(*(tables[n] for n in ORDER_TABLES[1:]))


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    span = tables["orders_raw"].agg(observe.seconds_between(F.min("event_time").cast("timestamp_ntz"), F.max("event_time").cast("timestamp_ntz")).alias("seconds"))
    return observe.validate_run(an.table_counts(tables), span)


def stream_kpis(t: Tables) -> DataFrame:
    layout = _layout(t, customers=False, products=False)
    _drain(jobs.start_kpis(layout, trigger={"availableNow": True}))
    return _ntz(layout.table("dashboard_kpis").read_current())


def stream_chained(t: Tables, name: str) -> DataFrame:
    """Windows over windows, drained from the log by one query."""
    layout = _layout(t, customers=False, products=name == "category_rollup")
    _drain(jobs.start_chained(layout, name, trigger={"availableNow": True}))
    return _ntz(jobs.read_emitted(layout, name))


def stream_late_rows(t: Tables) -> DataFrame:
    """Orders by window and city, from the published windows and the side output of late
    rows. Orders come in by their time, but for some, which come after all others."""
    layout = jobs.Layout(t.spark, scratch_dir(t.spark, "late"))
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    late = F.pmod(F.xxhash64("order_id"), F.lit(10)) == 0
    day = F.to_date("event_time")
    low, high = raw.agg(F.min(day), F.max(day)).first()
    middle = low + (high - low) / 2 if low else None
    for part in (raw.where(~late & (day < F.lit(middle))), raw.where(~late & (day >= F.lit(middle))), raw.where(late)):
        append_log(part, layout.raw_path)
    _drain(jobs.start_city_revenue(layout, trigger={"availableNow": True}, max_files_per_trigger=8, side_output=True))
    published = layout.table("city_revenue_5min").read_current().select("window_start", "window_end", "city", F.col("total_orders").alias("n"))
    side = lateness.late_orders(t.spark, layout.root, "city_revenue_5min").select(
        F.window("event_time", "5 minutes").alias("w"), "city").select("w.start", "w.end", "city", F.lit(1).alias("n"))
    both = published.union(side).groupBy("window_start", "window_end", "city").agg(F.sum("n").cast("bigint").alias("orders"))
    return _ntz(both)


REPLAYED_DAY = "20240115"


def stream_dedup(t: Tables) -> DataFrame:
    """X11: orders by day after a day was delivered twice, the copies taken out by keyed state."""
    layout = jobs.Layout(t.spark, scratch_dir(t.spark, "dedup"))
    raw = t.raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    day = F.col("event_day")
    for part in (raw.where(day <= REPLAYED_DAY), raw.where(day == REPLAYED_DAY), raw.where((day > REPLAYED_DAY) | day.isNull())):
        append_log(part, layout.raw_path)
    _drain(jobs.start_dedup(layout, "2 days", trigger={"availableNow": True}, max_files_per_trigger=8))
    return jobs.read_emitted(layout, "orders_unique").groupBy("event_day").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_amount").cast("decimal(20,2)").alias("revenue"))


def measured(t: Tables, slices: int = 4) -> jobs.Layout:
    """A deployment that the given orders were replayed through while its jobs ran: enrichment,
    windows and timed dashboard reads, with their progress stored. The windows are as short as
    the replay's slices need, so that some close while it runs."""
    layout = jobs.Layout(t.spark, scratch_dir(t.spark, "measured"))
    layout.table("customer_profile").upsert(t.customers)
    layout.table("product_catalog").upsert(t.products)
    append_log(t.raw.limit(0).withColumn("event_time", F.col("event_time").cast("timestamp")), layout.raw_path)
    recorder = layout.recorder()
    t.spark.streams.addListener(recorder)
    try:
        often = {"processingTime": "0 seconds"}
        queries = [jobs.start_enrich_and_alert(layout, trigger=often), jobs.start_revenue(layout, "2 seconds", trigger=often)]

        def after(i: int) -> None:
            for query in queries:
                query.processAllAvailable()
            revenue = layout.table("revenue_5min").read_current()
            telemetry.timed_queries(t.spark, layout.root, {"latest_windows": an.latest_windows(revenue, "category", 30),
                                                          "category_rollup": an.rollup_windows(revenue, "category")})

        try:
            jobs.replay(layout, t.raw, slices, after=after)
        finally:
            for query in queries:
                query.stop()
        recorder.wait(*queries)
    finally:
        t.spark.streams.removeListener(recorder)
    return layout


def stream_slo_report(t: Tables) -> DataFrame:
    """O9 over measured times: five objectives, whose samples the replay stored."""
    layout = measured(t)
    samples = telemetry.slo_samples(t.spark, layout.root, layout.raw_path)
    return observe.slo_report(samples, {slo[0]: slo[1] for slo in rules.SLO_BURN})


def stream_burn_rate(t: Tables) -> DataFrame:
    """O10 over measured times, all objectives."""
    layout = measured(t)
    return observe.burn_rates(telemetry.slo_samples(t.spark, layout.root, layout.raw_path))
