"""Objectives from measured times: the reports against SQL over the tables that were stored."""
import datetime as dt
import glob
import math

import duckdb
import pytest

from conftest import SF_SMALL, raw_df, raw_row
from tidemark.functions import rules
from tidemark.operators import observe
from tidemark.plans import streams
from tidemark.plans.frames import Tables
from tidemark.sources.log import append_log
from tidemark.streaming import jobs, telemetry

OBJECTIVES = {slo[0]: slo[1] for slo in rules.SLO_BURN}


@pytest.fixture(scope="module")
def layout(spark):
    return streams.measured(Tables(spark, SF_SMALL), slices=3)


def test_samples_come_from_stored_times(spark, layout):
    samples = telemetry.slo_samples(spark, layout.root, layout.raw_path).collect()
    by = {}
    for s in samples:
        by.setdefault(s.metric, []).append(s.value)
    assert set(by) == set(OBJECTIVES)
    assert len(by["ingestion_latency"]) == spark.read.parquet(layout.raw_path).count()
    assert all(v > -0.5 for v in by["ingestion_latency"]) and all(v > 0 for v in by["query_latency"]) and set(by["failed_batches"]) == {0.0}
    # orders are up to 15 seconds old when they are written: some break the objective of 5
    assert 0 < sum(v > 5 for v in by["ingestion_latency"]) < len(by["ingestion_latency"])
    # the log's times are those of its files
    newest = max(s.ts for s in samples if s.metric == "ingestion_latency")
    import os
    written = max(os.path.getmtime(f) for f in glob.glob(f"{layout.raw_path}/*/*.parquet"))
    assert abs(newest.timestamp() - written) < 1.1


def test_reports_equal_sql_over_the_stored_samples(spark, layout, scratch):
    samples = telemetry.slo_samples(spark, layout.root, layout.raw_path)
    samples.write.parquet(f"{scratch}/samples")
    stored = spark.read.parquet(f"{scratch}/samples")
    con = duckdb.connect()
    con.execute(f"SET TimeZone='UTC'; CREATE VIEW samples AS SELECT metric, ts::TIMESTAMP AS ts, value FROM read_parquet('{scratch}/samples/*.parquet')")
    con.execute("CREATE TABLE slo (metric VARCHAR, objective DOUBLE, fast DOUBLE, slow DOUBLE)")
    con.executemany("INSERT INTO slo VALUES (?, ?, ?, ?)", rules.SLO_BURN)
    want = con.execute(f"""
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value) AS k, count(*) OVER (PARTITION BY metric) AS n FROM samples)
        SELECT metric, n, count(*) FILTER (value < objective), objective, min(value) FILTER (k >= ceil(n::DOUBLE * {rules.SLO_PERCENTILE}))
        FROM r JOIN slo USING (metric) GROUP BY metric, n, objective""").fetchall()
    got = observe.slo_report(stored, OBJECTIVES).collect()
    assert sorted((r.metric, r.samples, r.within, r.objective, r.p_value) for r in got) == sorted(want)
    assert all(r.met == (r.p_value < r.objective) and r.compliance == r.within / r.samples for r in got)
    want = con.execute("\n UNION ALL ".join(f"""
        SELECT metric, '{label}', epoch(time_bucket(INTERVAL '{width}', ts)), count(*), count(*) FILTER (value > objective), min({k}),
               count(*) FILTER (value > objective) / count(*) > min({k})
        FROM samples JOIN slo USING (metric) WHERE {k} IS NOT NULL GROUP BY metric, time_bucket(INTERVAL '{width}', ts)"""
                                            for label, width, k in (("fast_1h", "1 hour", "fast"), ("slow_6h", "6 hours", "slow")))).fetchall()
    got = observe.burn_rates(stored).collect()
    epoch = lambda t: t.replace(tzinfo=dt.timezone.utc).timestamp()
    assert sorted((r.metric, r.burn_window, epoch(r.window_start), r.samples, r.bad, r.threshold, r.alert) for r in got) == sorted(want)
    assert any(r.alert for r in got) and not any(r.alert for r in got if r.metric == "failed_batches")


def test_every_batch_is_recorded_also_after_a_restart(spark, scratch):
    lay = jobs.Layout(spark, scratch)
    recorder = lay.recorder()
    spark.streams.addListener(recorder)
    try:
        queries = []
        for i, t in enumerate(["00:01:00", "00:09:00", "00:02:00", "00:30:00", "00:03:00"]):
            raw_df(spark, [raw_row(f"O{i}", "1.00", time=f"2024-01-01 {t}")]).coalesce(1).write.mode("append").partitionBy("event_day").parquet(lay.raw_path)
            q = jobs.start_city_revenue(lay, trigger={"availableNow": True})
            q.awaitTermination()
            queries.append(q)
            if i == 1:   # a new listener goes on from what is stored
                recorder.wait(q)
                spark.streams.removeListener(recorder)
                recorder = lay.recorder()
                spark.streams.addListener(recorder)
        recorder.wait(*queries[2:])
    finally:
        spark.streams.removeListener(recorder)
    rows = telemetry.read_progress(spark, scratch).collect()
    assert sum(r.input_rows for r in rows) == 5 and not any(r.failed for r in rows) and len({r.run_id for r in rows}) == 5
    newest = [r.newest_event for r in sorted(rows, key=lambda r: (r.started_at, r.batch_id)) if r.newest_event]
    assert newest == sorted(newest)          # rows that come late do not set the newest time back
    assert telemetry.dropped_rows(spark, scratch).first().dropped_rows >= 2
    delays = telemetry.completion_delays(spark, scratch).collect()
    assert delays and all(math.isfinite(r.delay_seconds) and r.delay_seconds > 3e7 for r in delays)


def test_a_failed_batch_is_a_sample(spark, scratch):
    lay = jobs.Layout(spark, scratch)
    append_log(raw_df(spark, [raw_row("O1", "1.00")]), lay.raw_path)
    recorder = lay.recorder()
    spark.streams.addListener(recorder)
    try:
        def broken(batch, batch_id):
            raise ValueError("no such table")
        q = jobs._start(jobs.raw_stream(lay, watermark=None), broken, lay.checkpoint("enrich_alert"), {"availableNow": True}, name=lay.query_name("enrich_alert"))
        with pytest.raises(Exception):
            q.awaitTermination()
        recorder.wait(q)
    finally:
        spark.streams.removeListener(recorder)
    row = telemetry.read_progress(spark, scratch).where("failed").first()
    assert row.job == "enrich_alert" and "no such table" in row.error
    report = {r.metric: r for r in observe.slo_report(telemetry.slo_samples(spark, scratch, lay.raw_path), OBJECTIVES).collect()}
    assert not report["failed_batches"].met and report["failed_batches"].p_value == 1.0
    alerts = observe.burn_rates(telemetry.slo_samples(spark, scratch, lay.raw_path)).where("metric = 'failed_batches'").collect()
    assert [r.alert for r in alerts] == [True]


def test_nothing_recorded(spark, scratch):
    assert telemetry.read_progress(spark, scratch).collect() == [] and telemetry.dropped_rows(spark, scratch).collect() == []
