"""O1-O12 (+ X4, Q9): observability computed as data.

Sliding and sustained conditions are evaluated without ordered window functions over whole
series: each window row is fanned out to the bounded set of later windows it influences
(``k`` rows, a constant), then an ordinary grouped aggregate combines them. That keeps every
group small and lets partial aggregation work, no matter how long the series is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.exprs import seconds_between
from tidemark.operators.ordered import nearest_rank, running_total
from tidemark.operators.windows import window_seconds


def _now(now) -> F.Column:
    return now if isinstance(now, F.Column) else F.lit(now).cast("timestamp_ntz")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def lag_seconds(tables: dict[str, DataFrame], now, col: str = "event_time") -> DataFrame:
    """O1: TIMESTAMPDIFF(SECOND, MAX(event_time), now) per table."""
    return _union([df.agg(F.max(col).alias("m")).select(
        F.lit(name).alias("table_name"),
        seconds_between(F.col("m").cast("timestamp_ntz"), _now(now)).alias("lag_seconds"))
        for name, df in tables.items()])


def lag_of(newest: DataFrame, now) -> DataFrame:
    """O1 from rows (table_name, newest)."""
    return newest.select("table_name", seconds_between(
        F.col("newest").cast("timestamp_ntz"), _now(now)).alias("lag_seconds"))


def freshness_seconds(tables: dict[str, DataFrame], now, col: str = "window_end") -> DataFrame:
    """O2: TIMESTAMPDIFF(SECOND, MAX(window_end), now) per aggregate table."""
    return _union([df.agg(F.max(col).alias("m")).select(
        F.lit(name).alias("table_name"),
        seconds_between(F.col("m").cast("timestamp_ntz"), _now(now)).alias("freshness_seconds"))
        for name, df in tables.items()])


def completion_delay(changelog: DataFrame, written_col: str = "_written_at") -> DataFrame:
    """O3: MAX(written_at - window_end) in seconds, from a changelog that records write time."""
    return changelog.agg(F.max(F.unix_timestamp(written_col) - F.unix_timestamp("window_end"))
                         .alias("completion_delay_seconds"))


def input_rate(raw: DataFrame, width: str = "1 minute") -> DataFrame:
    """O4 (= A7): events and events per second per window."""
    secs = float(window_seconds(width))
    return (raw.groupBy(F.window("event_time", width).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "events", (F.col("events") / F.lit(secs)).alias("events_per_second")))


def throughput_timeline(raw: DataFrame, start, interval: str = "1 hour",
                        time_col: str = "event_time", weight_col: str | None = None) -> DataFrame:
    """Records per interval since ``start``, elapsed seconds, throughput, and the running
    total of records up to the end of each interval (a distributed prefix sum over intervals).
    ``weight_col``: rows already carry a count (e.g. input rows of a micro-batch)."""
    secs = float(window_seconds(interval))
    records = F.sum(weight_col).cast("long") if weight_col else F.count(F.lit(1))
    intervals = (raw.where(F.col(time_col) >= F.lit(start).cast(raw.schema[time_col].dataType))
                 .groupBy(F.window(time_col, interval).alias("w"))
                 .agg(records.alias("records"))
                 .select(F.col("w.start").alias("interval_start"),
                         seconds_between(_now(start), F.col("w.start").cast("timestamp_ntz"))
                         .alias("elapsed_seconds"),
                         "records", (F.col("records") / F.lit(secs)).alias("events_per_second")))
    return running_total(intervals, [F.col("interval_start").asc()], "records", "cumulative_records")


PROGRESS_SCHEMA = ("batch_id long, ts string, input_rows long, input_rows_per_second double, "
                   "processed_rows_per_second double, trigger_ms long, dropped_late_rows long")


def progress_frame(spark, query) -> DataFrame:
    """O5/O8 source: a streaming query's recent progress (one small row per micro-batch, kept
    by Spark for the last ``spark.sql.streaming.numRecentProgressUpdates`` batches)."""
    rows = []
    for p in query.recentProgress:
        dropped = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
        rows.append((p["batchId"], p["timestamp"], p["numInputRows"],
                     float(p.get("inputRowsPerSecond") or 0.0),
                     float(p.get("processedRowsPerSecond") or 0.0),
                     int(p["durationMs"].get("triggerExecution", 0)), dropped))
    df = spark.createDataFrame(rows, PROGRESS_SCHEMA)
    return df.withColumn("ts", F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSX"))


def _fan_out(df: DataFrame, time_col: str, width: str, offsets: range) -> DataFrame:
    """Each row copied to the window start ``time_col + i*width`` for i in offsets (bounded)."""
    step = window_seconds(width)
    shifts = F.array(*[F.lit(i) for i in offsets])
    return (df.select("*", F.explode(shifts).alias("_offset"))
            .withColumn("target", F.col(time_col) + F.make_dt_interval(
                secs=F.col("_offset") * F.lit(step))))


def alert_failed_rate(rev: DataFrame, threshold: float = rules.FAILED_RATE_ALERT,
                      windows: int = rules.FAILED_RATE_ALERT_WINDOWS,
                      width: str = "5 minutes") -> DataFrame:
    """Windows where failed/total (over all categories) stayed above ``threshold`` for
    ``windows`` consecutive windows ending at this one. A missing window breaks the run."""
    per_window = (rev.groupBy("window_start", "window_end")
                  .agg(F.sum("failed_payments").alias("failed"), F.sum("total_orders").alias("orders"))
                  .withColumn("failed_rate", F.col("failed").cast("double") / F.col("orders")))
    hot = per_window.where(F.col("failed_rate") > threshold)
    fanned = _fan_out(hot, "window_start", width, range(windows))
    runs = (fanned.groupBy("target")
            .agg(F.count(F.lit(1)).alias("run"),
                 F.max(F.when(F.col("_offset") == 0, F.col("failed_rate"))).alias("failed_rate"),
                 F.max(F.when(F.col("_offset") == 0, F.col("window_end"))).alias("window_end")))
    return (runs.where(F.col("run") == windows)
            .select(F.col("target").alias("window_start"), "window_end", "failed_rate"))


def alert_spike(alerts_df: DataFrame, factor: float = rules.SPIKE_FACTOR,
                baseline_windows: int = rules.SPIKE_BASELINE_WINDOWS,
                width: str = "5 minutes", time_col: str = "event_time") -> DataFrame:
    """Windows whose alert count exceeds ``factor`` x the average count of the preceding
    ``baseline_windows`` window slots (empty slots count as 0; a zero baseline never fires)."""
    counts = (alerts_df.groupBy(F.window(time_col, width).alias("w"))
              .agg(F.count(F.lit(1)).alias("alerts"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "alerts"))
    # offset 0 carries a window's own count, offsets 1..k feed the baseline of later windows:
    # one aggregate, no join, the counts are computed once
    fanned = _fan_out(counts, "window_start", width, range(0, baseline_windows + 1))
    own = F.col("_offset") == 0
    slots = (fanned.groupBy("target")
             .agg(F.sum(F.when(own, F.col("alerts"))).alias("alerts"),
                  F.max(F.when(own, F.col("window_end"))).alias("window_end"),
                  F.sum(F.when(~own, F.col("alerts"))).alias("history")))
    return (slots.where(F.col("alerts").isNotNull() & F.col("history").isNotNull())
            .select(F.col("target").alias("window_start"), "window_end", "alerts",
                    (F.col("history") / F.lit(float(baseline_windows))).alias("baseline"))
            .where((F.col("baseline") > 0) & (F.col("alerts") > F.lit(factor) * F.col("baseline"))))


def alert_threshold(series: DataFrame, value_col: str, limit: float, windows: int,
                    width: str, time_col: str = "window_start") -> DataFrame:
    """Generic sustained threshold (value > limit for ``windows`` consecutive windows)."""
    hot = series.where(F.col(value_col) > limit)
    fanned = _fan_out(hot, time_col, width, range(windows))
    return (fanned.groupBy("target").agg(F.count(F.lit(1)).alias("run"))
            .where(F.col("run") == windows).select(F.col("target").alias(time_col)))


def ingestion_latency_samples(raw: DataFrame, trigger: str = "1 minute") -> DataFrame:
    """Latency samples under a fixed trigger interval: an event becomes visible when the
    micro-batch covering it commits, i.e. at the end of its trigger slot."""
    slot_end = F.window("event_time", trigger).end
    return raw.select(
        F.lit("ingestion_latency").alias("metric"), F.col("event_time").alias("ts"),
        ((F.unix_micros(slot_end.cast("timestamp")) - F.unix_micros(F.col("event_time").cast("timestamp")))
         / F.lit(1_000_000.0)).alias("value"))


def slo_report(samples: DataFrame, objectives: dict[str, float],
               percentile: float = rules.SLO_PERCENTILE) -> DataFrame:
    """Per metric — samples, exact nearest-rank percentile (``ordered.nearest_rank``: counts
    in value ranges, no sorted series), share within the objective."""
    known = samples.where(F.col("metric").isin(list(objectives)) & F.col("value").isNotNull())
    ranks = nearest_rank(known, "metric", "value", percentile)

    def per_metric(values: dict) -> F.Column:
        pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))]
        return (F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0.0)))[F.col("metric")]

    objective = per_metric(objectives)
    return (known.groupBy("metric")
            .agg(F.count(F.lit(1)).alias("samples"),
                 F.sum(F.when(F.col("value") < objective, 1).otherwise(0)).cast("long").alias("within"))
            .withColumn("objective", objective).withColumn("p_value", per_metric(ranks))
            .withColumn("compliance", F.col("within").cast("double") / F.col("samples"))
            .withColumn("met", F.col("p_value") < F.col("objective")))


def burn_rate(samples: DataFrame, metric: str, objective: float, fast_share: float,
              slow_share: float) -> DataFrame:
    """Share of bad samples (value > objective) per 1-hour and 6-hour window, and whether
    it exceeds the fast / slow burn thresholds."""
    s = samples.where(F.col("metric") == metric)
    bad = F.when(F.col("value") > objective, 1).otherwise(0)

    def per(width: str, label: str, limit: float) -> DataFrame:
        return (s.groupBy(F.window("ts", width).alias("w"))
                .agg(F.count(F.lit(1)).alias("samples"), F.sum(bad).cast("long").alias("bad"))
                .select(F.lit(label).alias("burn_window"),
                        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "samples", "bad",
                        (F.col("bad").cast("double") / F.col("samples")).alias("bad_share"),
                        F.lit(limit).alias("threshold"))
                .withColumn("alert", F.col("bad_share") > F.col("threshold")))

    return per("1 hour", "fast_1h", fast_share).unionByName(per("6 hours", "slow_6h", slow_share))


def burn_rates(samples: DataFrame, slos=tuple(rules.SLO_BURN)) -> DataFrame:
    """O10 for several objectives in one scan: samples are summed by metric and hour, and the
    hours into six; a metric without a slow threshold has no slow alerts."""
    def per_metric(k: int) -> F.Column:
        return F.create_map(*[x for slo in slos for x in (F.lit(slo[0]), F.lit(slo[k]).cast("double"))])[F.col("metric")]

    known = samples.where(F.col("metric").isin([s[0] for s in slos]) & F.col("value").isNotNull())
    hours = (known.groupBy("metric", F.window("ts", "1 hour").alias("w"))
             .agg(F.count(F.lit(1)).alias("samples"), F.sum(F.when(F.col("value") > per_metric(1), 1).otherwise(0)).cast("long").alias("bad")))
    six = (hours.groupBy("metric", F.window(F.col("w.start"), "6 hours").alias("w"))
           .agg(F.sum("samples").alias("samples"), F.sum("bad").alias("bad")))

    def judged(df: DataFrame, label: str, k: int) -> DataFrame:
        return (df.select("metric", F.lit(label).alias("burn_window"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "samples", "bad", (F.col("bad").cast("double") / F.col("samples")).alias("bad_share"), per_metric(k).alias("threshold"))
                .where("threshold is not null").withColumn("alert", F.col("bad_share") > F.col("threshold")))

    return judged(hours, "fast_1h", 2).unionByName(judged(six, "slow_6h", 3))


def validate_run(counts: DataFrame, seconds_col: DataFrame) -> DataFrame:
    """Load-run checks from (table_name, row_count) rows and a one-row duration frame.

    Both inputs are tiny; they are combined by a union and a grouped max, never a cross join.
    """
    tagged = counts.select("table_name", F.col("row_count").cast("double").alias("v")) \
        .unionByName(seconds_col.select(F.lit("_seconds").alias("table_name"),
                                        F.col("seconds").cast("double").alias("v")))
    row = tagged.agg(*[F.max(F.when(F.col("table_name") == n, F.col("v"))).alias(n)
                       for n in ["orders_raw", "orders_enriched", "high_value_orders",
                                 "suspicious_orders", "_seconds"]])
    checks = F.array(
        F.struct(F.lit("throughput_events_per_second").alias("check_name"),
                 (F.col("orders_raw") / F.col("_seconds")).alias("value"),
                 F.lit(float(rules.RUN_MIN_THROUGHPUT)).alias("threshold")),
        F.struct(F.lit("enriched_ratio").alias("check_name"),
                 (F.col("orders_enriched") / F.col("orders_raw")).alias("value"),
                 F.lit(rules.RUN_MIN_ENRICHED_RATIO).alias("threshold")),
        *[F.struct(F.lit(f"{n}_count").alias("check_name"), F.col(n).alias("value"),
                   F.lit(1.0).alias("threshold"))
          for n in ["orders_raw", "orders_enriched", "high_value_orders", "suspicious_orders"]])
    out = row.select(F.inline(checks))
    return out.withColumn("passed", F.when(F.col("check_name") == "enriched_ratio",
                                           F.col("value") > F.col("threshold"))
                          .otherwise(F.col("value") >= F.col("threshold")))


def classify(metrics: DataFrame) -> DataFrame:
    """Capacity levels — utilisation 70/90 %, lag 30/120 s."""
    level = (F.when((F.col("metric") == "utilisation") & (F.col("value") >= 0.9), "CRITICAL")
             .when((F.col("metric") == "utilisation") & (F.col("value") >= 0.7), "WARNING")
             .when((F.col("metric") == "lag_seconds") & (F.col("value") > 120), "CRITICAL")
             .when((F.col("metric") == "lag_seconds") & (F.col("value") > 30), "WARNING")
             .otherwise("OK"))
    return metrics.withColumn("level", level)


def utilisation(rate: DataFrame, capacity: float, value_col: str = "events_per_second") -> DataFrame:
    """O12 input: the load of each window as a share of a capacity (rows (metric, value))."""
    return rate.select("window_start", F.lit("utilisation").alias("metric"), (F.col(value_col) / F.lit(float(capacity))).alias("value"))


def late_rate(raw: DataFrame, published: DataFrame, key: str = "category",
              products: DataFrame | None = None, width: str = "5 minutes") -> DataFrame:
    """Q9: late (dropped) rows as a share of all logged rows."""
    late = late_rows(raw, published, key, products, width).agg(F.sum("late").alias("late"))
    total = raw.agg(F.count(F.lit(1)).alias("total"))
    both = late.select(F.coalesce("late", F.lit(0)).cast("long").alias("v"), F.lit("late").alias("k")) \
        .unionByName(total.select(F.col("total").alias("v"), F.lit("total").alias("k")))
    row = both.agg(F.max(F.when(F.col("k") == "late", F.col("v"))).alias("late_rows"),
                   F.max(F.when(F.col("k") == "total", F.col("v"))).alias("total_rows"))
    return row.withColumn("late_rate", F.col("late_rows").cast("double") / F.col("total_rows"))


def late_rows(raw: DataFrame, published: DataFrame, key: str = "category",
              products: DataFrame | None = None, width: str = "5 minutes") -> DataFrame:
    """Rows the log holds but the published windows missed (dropped as late):
    recount the log per window and compare with the published counts."""
    src = raw
    if key == "category" and products is not None:
        from tidemark.operators.enrich import bounded_broadcast
        src = raw.join(bounded_broadcast(products.select("product_id", "category")),
                       "product_id", "left")
    recount = (src.groupBy(F.window("event_time", width).alias("w"), key)
               .agg(F.count(F.lit(1)).alias("logged"))
               .select(F.col("w.start").alias("window_start"), key, "logged"))
    pub = published.select("window_start", key, F.col("total_orders").alias("published"))
    cond = [recount.window_start == pub.window_start, recount[key].eqNullSafe(pub[key])]
    joined = recount.join(pub, cond, "left").select(
        recount.window_start, recount[key], "logged",
        F.coalesce(F.col("published"), F.lit(0)).alias("published"))
    return joined.withColumn("late", F.col("logged") - F.col("published")).where(F.col("late") > 0)
