"""The streaming jobs, built from the same DataFrame transforms as batch.

Topology (X15): generator -> orders_raw (file sink) ; orders_raw -> enrich + alerts ;
orders_raw -> revenue_5min ; orders_raw -> city_revenue_5min ; orders_raw -> dashboard_kpis.
Jobs are linked only through tables, like the reference's.

* Dimension lookups happen inside ``foreachBatch`` on a fresh read of the dimension, so a
  dimension update is seen by the next micro-batch (a static side would be frozen at start).
* Windowed jobs keep state per (window, key) with a watermark and emit each window once, when
  it closes (append mode); ``foreachBatch`` then upserts the closed windows.
* Sinks are upsert tables: each micro-batch overwrites its own (epoch, batch_id) directory, so
  a batch replayed after a failure rewrites the same files (exactly-once results).
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import rules
from tidemark.operators import alerts, chained, enrich, quality, windows
from tidemark.operators.ingest import to_orders_raw
from tidemark.sources import purge
from tidemark.sources.log import append_log, read_log, start_log_writer
from tidemark.sources.upsert import UpsertTable, fs_read_text, fs_write_text
from tidemark.streaming import keyed, lateness
from tidemark.streaming.telemetry import ProgressRecorder, observed

WATERMARK = "5 seconds"
JOBS = ("enrich_alert", "revenue_5min", "city_revenue_5min", "dashboard_kpis",
        "city_rollup", "category_rollup", "alert_rate", "failed_rate_alerts", "spike_alerts", "orders_unique")


@dataclass
class Layout:
    """Where one deployment keeps its tables and stream checkpoints.

    compact_every (L5, L7): a job folds each of its tables after so many of its batches, and drops
    the changelog that the last but one fold had folded; reading a table then costs a bounded
    tail, however long the job runs. None: tables are folded by hand."""
    spark: SparkSession
    root: str
    compact_every: int | None = None

    @property
    def raw_path(self) -> str:
        return f"{self.root}/orders_raw"

    @property
    def errors_path(self) -> str:
        return f"{self.root}/error_events"

    @property
    def purged_path(self) -> str:
        return f"{self.root}/purged_keys"

    def log(self) -> DataFrame:
        """The log without purged customers."""
        return purge.without(read_log(self.spark, self.raw_path), self.purged_path)

    def table(self, name: str) -> UpsertTable:
        return UpsertTable.named(self.spark, self.root, name)

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/_checkpoints/{job}"

    def query_name(self, job: str) -> str:
        """Unique for each deployment: several layouts may run in one session."""
        return f"{job}_{hashlib.sha1(self.checkpoint(job).encode()).hexdigest()[:8]}"

    def recorder(self) -> ProgressRecorder:
        """A listener that stores the progress of this deployment's queries; the caller adds it
        to ``spark.streams`` and removes it."""
        return ProgressRecorder(self.spark, self.root, {self.query_name(j): j for j in JOBS})


class DimensionCache:
    """Per-query cache of a dimension's current view for foreachBatch lookups.

    The view is re-read (and its broadcast size re-checked) only when the table's storage
    changed since the previous micro-batch; otherwise the persisted view is reused. A lost
    cached block is recomputed from its files, so this is safe under executor loss.
    """

    def __init__(self, table: UpsertTable, columns: list[str]):
        self.table, self.columns = table, columns
        self._sig, self._df, self._small = None, None, None

    def get(self) -> tuple[DataFrame, bool]:
        sig = self.table.signature()
        if sig != self._sig:
            if self._df is not None:
                self._df.unpersist()
            # The storage signature is part of the plan: Spark's cache lookup matches plans,
            # and a directory's plan alone does not change when its files do.
            tag = F.lit(hashlib.sha1(repr(sig).encode()).hexdigest()).alias("_snapshot")
            key, *cols = self.columns
            view = enrich.one_per_key(self.table.read_current(), key, cols)
            self._df = view.select(*self.columns, tag).drop("_snapshot").persist()
            self._small = enrich.fits_broadcast(self._df)
            if not self._small:   # a table, so that AQE can split the orders of a hot key
                cached, self._df = self._df, enrich.written(self._df)
                cached.unpersist()
            self._sig = sig
        return self._df, self._small


def stream_epoch(table: UpsertTable, checkpoint: str) -> int:
    """A fresh changelog epoch for every start of a query.

    Batch ids restart at 0 on a new checkpoint and continue on an old one; either way the new
    epoch orders this run's writes after everything already in the table (e.g. a rebuild
    done while the query was stopped). A batch that Spark re-executes after a restart is
    deterministic, so its copy under the new epoch carries the same rows. The epochs used are
    recorded next to the checkpoint for audit (``epochs_of``).
    """
    marker = f"{checkpoint}.epochs.json"
    text = fs_read_text(table.spark, marker)
    known = json.loads(text) if text else {}
    epoch = table.new_epoch()
    known.setdefault(table.root, []).append(epoch)
    fs_write_text(table.spark, marker, json.dumps(known))
    return epoch


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """What tells a checkpoint from another one in its place: batch ids start again with it."""
    marker = f"{checkpoint}/tidemark_id"
    known = fs_read_text(spark, marker)
    if not known:
        known = uuid.uuid4().hex[:12]
        fs_write_text(spark, marker, known)
    return known


def write_errors(layout: Layout, rows: DataFrame, source: str, batch_id: int, kind: str) -> None:
    """Dead letters of a batch, in its own folder: a batch that is run again, also by a later
    start of the query, replaces what it wrote."""
    rows.write.mode("overwrite").parquet(f"{layout.errors_path}/source={source}/batch_id={batch_id}/kind={kind}")


def epochs_of(table: UpsertTable, checkpoint: str) -> list[int]:
    text = fs_read_text(table.spark, f"{checkpoint}.epochs.json")
    return (json.loads(text) if text else {}).get(table.root, [])


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a stateful query's state: fixed at its first start (kept in the
    checkpoint). Configurable; defaults to the cluster's default parallelism."""
    return int(spark.conf.get("tidemark.state.partitions",
                              str(spark.sparkContext.defaultParallelism)))


def _start(df: DataFrame, process, checkpoint: str, trigger: dict | None, mode: str = "append",
           name: str | None = None):
    spark = df.sparkSession
    w = (df.writeStream.outputMode(mode).foreachBatch(process)
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions(spark)))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def store(layout: Layout, table: UpsertTable, rows: DataFrame, epoch: int, batch_id: int) -> None:
    """Write a micro-batch to a keyed table of this job, its only writer, and fold the table when
    its time has come. Files that an open read may still use stay until the next fold."""
    table.write_batch(rows, epoch, batch_id)
    if layout.compact_every and batch_id % layout.compact_every == layout.compact_every - 1:
        table.expire(keep_versions=1)
        table.compact()


def raw_stream(layout: Layout, max_files_per_trigger: int | None = None,
               watermark: str | None = WATERMARK) -> DataFrame:
    """The log as a stream, event time watermarked (bounded out-of-orderness)."""
    df = read_log(layout.spark, layout.raw_path, streaming=True,
                  max_files_per_trigger=max_files_per_trigger)
    df = observed(df, "input", "event_time")
    return df.withWatermark("event_time", watermark) if watermark else df


def start_ingest(layout: Layout, generator_rows: DataFrame, trigger: dict | None = None):
    """Generator stream -> ingest projection -> append-only log."""
    return start_log_writer(to_orders_raw(generator_rows), layout.raw_path,
                            layout.checkpoint("ingest"), trigger=trigger or {"processingTime": "1 second"})


def start_enrich_and_alert(layout: Layout, trigger: dict | None = None, on_miss: str = "null",
                           max_files_per_trigger: int | None = None, validate_now: bool = False,
                           dedup_within: str | None = None):
    """X5/X6 (+Q7 when ``validate_now``): one query over orders_raw; per micro-batch the batch
    is enriched once and written to orders_enriched, high_value_orders, suspicious_orders.

    dedup_within (X11), e.g. "1 hour": an order_id whose earlier copy lies within that event-time
    horizon is dropped, by keyed state (``keyed.first_copies``); an order that merely comes late
    is kept (no watermark drops it)."""
    ckpt = layout.checkpoint("enrich_alert")
    names = ["orders_enriched", "high_value_orders", "suspicious_orders"]
    tables = {n: layout.table(n) for n in names}
    epochs = {n: stream_epoch(t, ckpt) for n, t in tables.items()}
    source = checkpoint_id(layout.spark, ckpt)
    customers = DimensionCache(layout.table("customer_profile"),
                               ["customer_id", *enrich.CUSTOMER_COLS])
    products = DimensionCache(layout.table("product_catalog"), ["product_id", *enrich.PRODUCT_COLS])

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = purge.without(batch, layout.purged_path)
        if validate_now:   # the batch feeds two outputs: read it once
            batch = batch.persist()
            tagged = quality.tag_errors(batch, F.current_timestamp().cast("timestamp_ntz")).persist()
            write_errors(layout, quality.error_rows(tagged, F.current_timestamp()), source, batch_id, "validation")
            good = quality.valid_rows(tagged)
        else:
            tagged, good = None, batch
        (cust, small_c), (prod, small_p) = customers.get(), products.get()
        cached = enrich.enrich(good, cust, prod, on_miss=on_miss, small_customers=small_c,
                               small_products=small_p, unique_dims=True, flags=on_miss == "dlq").persist()
        enriched = cached
        if on_miss == "dlq":
            enriched, misses = quality.split_misses(cached, F.current_timestamp())
            write_errors(layout, misses, source, batch_id, "lookup")
        for name, rows in (("orders_enriched", enriched), ("high_value_orders", alerts.high_value(enriched)),
                           ("suspicious_orders", alerts.suspicious(enriched))):
            store(layout, tables[name], rows, epochs[name], batch_id)
        cached.unpersist()
        if tagged is not None:
            tagged.unpersist()
            batch.unpersist()

    src = raw_stream(layout, max_files_per_trigger, watermark=None)
    if dedup_within:
        src = keyed.first_copies(src, "order_id", dedup_within)
    return _start(src, process, ckpt, trigger, name=layout.query_name("enrich_alert"))


def _start_windows(layout: Layout, table: str, aggregate, publish, time_col: str, width: str, watermark: str,
                   trigger: dict | None, max_files: int | None, side_output: bool):
    """A windowed query: ``aggregate(orders)`` in append mode, ``publish(windows, batch_id)`` for
    what has closed; with ``side_output`` late rows go to their table (``lateness``)."""
    ckpt, name = layout.checkpoint(table), layout.query_name(table)
    if not side_output:
        rows = aggregate(raw_stream(layout, max_files, watermark))
        return _start(observed(rows, "output", time_col), publish, ckpt, trigger, name=name)
    late = lateness.LateSplitter(layout.spark, layout.root, table, checkpoint_id(layout.spark, ckpt), width, watermark)
    orders = raw_stream(layout, max_files, None)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        publish(batch.where("window is not null").select("window.*"), batch_id)
        late.split(batch.where("row is not null").select("row.*"), batch_id)
        batch.unpersist()

    rows = lateness.with_rows(aggregate(orders.withWatermark("event_time", watermark)), orders)
    return _start(rows, process, ckpt, trigger, name=name)


def start_revenue(layout: Layout, width: str = "5 minutes", watermark: str = WATERMARK,
                  trigger: dict | None = None, max_files_per_trigger: int | None = None,
                  table: str = "revenue_5min", side_output: bool = False):
    """State per (window, product) partial sums; a closed window is rolled up to
    categories in foreachBatch against the catalog as of now (all of a closed window's groups
    leave in the same micro-batch, so the roll-up is complete)."""
    target = layout.table(table)
    epoch = stream_epoch(target, layout.checkpoint(table))
    products = DimensionCache(layout.table("product_catalog"), ["product_id", "category"])

    def publish(batch: DataFrame, batch_id: int) -> None:
        prod, small = products.get()
        store(layout, target, windows.rollup_partials(batch, prod, small, unique=True), epoch, batch_id)

    return _start_windows(layout, table, lambda orders: windows.product_window_partials(orders, width), publish, "w.end",
                          width, watermark, trigger, max_files_per_trigger, side_output)


def start_city_revenue(layout: Layout, width: str = "5 minutes", watermark: str = WATERMARK,
                       trigger: dict | None = None, max_files_per_trigger: int | None = None,
                       side_output: bool = False):
    """Windowed revenue by order city."""
    target = layout.table("city_revenue_5min")
    epoch = stream_epoch(target, layout.checkpoint("city_revenue_5min"))
    return _start_windows(layout, "city_revenue_5min", lambda orders: windows.city_revenue_by_window(orders, width),
                          lambda batch, batch_id: store(layout, target, batch, epoch, batch_id), "window_end",
                          width, watermark, trigger, max_files_per_trigger, side_output)


def start_kpis(layout: Layout, width: str = "1 minute", watermark: str = WATERMARK,
               trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """One windowed aggregate, five KPI rows per closed window, upserted by
    metric_key with the newest window winning (a late window cannot regress a tile)."""
    ckpt = layout.checkpoint("dashboard_kpis")
    target = layout.table("dashboard_kpis")
    epoch = stream_epoch(target, ckpt)

    def process(batch: DataFrame, batch_id: int) -> None:
        store(layout, target, batch, epoch, batch_id)

    rows = windows.kpis(raw_stream(layout, max_files_per_trigger, watermark), width)
    return _start(observed(rows, "output", "updated_at"), process, ckpt, trigger, name=layout.query_name("dashboard_kpis"))


def start_dedup(layout: Layout, within: str = "1 hour", trigger: dict | None = None,
                max_files_per_trigger: int | None = None):
    """X11: the log's orders without copies, emitted batch by batch (``read_emitted``)."""
    return _start_emitting(layout, "orders_unique", keyed.first_copies(raw_stream(layout, max_files_per_trigger, None), "order_id", within), trigger)


CHAINED = {"city_rollup": lambda orders: chained.rollup(orders, "city"),
           "category_rollup": lambda orders: chained.rollup(orders, "category"), "alert_rate": chained.alert_rate,
           "failed_rate_alerts": chained.failed_rate_alerts, "spike_alerts": chained.spike_alerts}


def start_chained(layout: Layout, name: str, watermark: str = WATERMARK, trigger: dict | None = None,
                  max_files_per_trigger: int | None = None):
    """Two chained event-time aggregates in one query; what each batch
    emits goes to its own folder of the table ``name`` (see ``read_emitted``). category_rollup
    takes categories from the catalog as it is when the query starts."""
    orders = raw_stream(layout, max_files_per_trigger, watermark)
    if name == "category_rollup":
        products = enrich.one_per_key(layout.table("product_catalog").read_current(), "product_id", ["category"])
        orders = orders.join(enrich.bounded_broadcast(products), "product_id", "left")
    return _start_emitting(layout, name, CHAINED[name](orders), trigger)


def _start_emitting(layout: Layout, name: str, rows: DataFrame, trigger: dict | None):
    ckpt = layout.checkpoint(name)
    source = checkpoint_id(layout.spark, ckpt)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{layout.root}/{name}/source={source}/batch_id={batch_id}")

    return _start(rows, process, ckpt, trigger, name=layout.query_name(name))


def read_emitted(layout: Layout, name: str) -> DataFrame:
    """What a query that emits batch by batch has put out, each row once."""
    return layout.spark.read.parquet(f"{layout.root}/{name}").drop("source", "batch_id")


def start_all(layout: Layout, generator_rows: DataFrame | None = None,
              trigger: dict | None = None, watermark: str = WATERMARK, on_miss: str = "null",
              revenue_width: str = "5 minutes", kpi_width: str = "1 minute",
              with_alerts: bool = True, max_files_per_trigger: int | None = None):
    """Every job of the topology; returns the started queries.

    Load-shedding levers (X13) are parameters: a tighter ``watermark`` (e.g. "2 seconds"),
    a wider ``revenue_width`` (e.g. "15 minutes"), ``with_alerts=False``, and a source rate
    limit via ``max_files_per_trigger`` (X14).
    """
    qs = []
    if generator_rows is not None:
        qs.append(start_ingest(layout, generator_rows))
    if with_alerts:
        qs.append(start_enrich_and_alert(layout, trigger, on_miss, max_files_per_trigger))
    qs.append(start_revenue(layout, revenue_width, watermark, trigger, max_files_per_trigger))
    qs.append(start_city_revenue(layout, revenue_width, watermark, trigger, max_files_per_trigger))
    qs.append(start_kpis(layout, kpi_width, watermark, trigger, max_files_per_trigger))
    return qs


def rebuild(layout: Layout, start, end, on_miss: str = "null",
            windows_too: bool = True, width: str = "5 minutes") -> dict:
    """Recompute the derived tables for event times in [start, end) from the raw log
    with the dimensions as they are now. The range's old rows are replaced: alerts, windows and
    orders that no longer come out of the log are gone. For the windowed tables the range is
    widened to whole windows. Lookup misses go to error_events with on_miss="dlq".

    Returns each table's snapshot version. Run it while the streaming writers are stopped (one
    writer per table); streams restarted afterwards take a newer epoch, so their writes win.
    """
    from tidemark.operators.analytics import between_times
    spark = layout.spark
    raw = between_times(layout.log(), start, end)
    customers = layout.table("customer_profile").read_current()
    products = layout.table("product_catalog").read_current()
    enriched = enrich.enrich(raw, customers, products, on_miss=on_miss, flags=on_miss == "dlq").persist()
    cached = enriched
    if on_miss == "dlq":
        enriched, misses = quality.split_misses(cached, F.current_timestamp())
        write_errors(layout, misses, f"rebuild-{layout.table('orders_enriched').new_epoch()}", 0, "lookup")
    bounds = [F.lit(str(x)).cast("timestamp") for x in (start, end)]
    within = (F.col("event_time") >= bounds[0]) & (F.col("event_time") < bounds[1])
    written = {}
    for name, rows in [("orders_enriched", enriched),
                       ("high_value_orders", alerts.high_value(enriched)),
                       ("suspicious_orders", alerts.suspicious(enriched))]:
        written[name] = layout.table(name).replace(within, rows)
    if windows_too:
        whole = spark.range(1).select(bounds[0].alias("a"), (bounds[1] - F.expr("INTERVAL 1 MICROSECOND")).alias("b"))
        low = whole.groupBy(F.window("a", width)).count().select(F.col("window.start").cast("string")).first()[0]
        high = whole.groupBy(F.window("b", width)).count().select(F.col("window.end").cast("string")).first()[0]
        raw = between_times(read_log(spark, layout.raw_path), low, high)
        covered = ((F.col("window_start") >= F.lit(low).cast("timestamp"))
                   & (F.col("window_start") < F.lit(high).cast("timestamp")))
        written["revenue_5min"] = layout.table("revenue_5min").replace(
            covered, windows.revenue_by_window(raw, products, width))
        written["city_revenue_5min"] = layout.table("city_revenue_5min").replace(
            covered, windows.city_revenue_by_window(raw, width))
    cached.unpersist()
    return written


def dropped_late_rows(query) -> int:
    """Rows the stateful operators dropped as late, over the recent progress that Spark
    keeps; ``telemetry.dropped_rows`` has the count over all batches of a recorded query."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def replay(layout: Layout, orders: DataFrame, slices: int = 4, span: float = 15.0, after=None) -> None:
    """Feed recorded orders into the log as if they came in now: slice after slice of their time,
    each slice's event times spread over the ``span`` seconds before it is written (sources
    deliver events up to that old). ``after(i)`` runs when slice i is in the log."""
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    low, high = orders.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return
    edges = [low + (high + 1 - low) * i // slices for i in range(slices + 1)]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if a == b:
            continue
        now = int(time.time() * 1e6)
        moved = F.timestamp_micros((F.lit(now) - (F.lit(b) - micros) * F.lit(span * 1e6 / (b - a))).cast("bigint"))
        rows = orders.where((micros >= a) & (micros < b)).withColumn("event_time", moved)
        append_log(rows.withColumn("event_day", F.date_format("event_time", "yyyyMMdd")), layout.raw_path)
        if after:
            after(i)
