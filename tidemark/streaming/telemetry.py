"""What streaming jobs measure of themselves, stored as tables.

``DataFrame.observe`` puts the newest event time of a micro-batch (and of what it publishes)
into the progress of a query; a ``ProgressRecorder`` listens and appends each progress row, and
each failure, below ``_progress`` of the deployment, one small file for each event. Nothing is
kept in memory but one time for each query, and nothing is cut: the table holds every batch.

``slo_samples`` reads the five objectives' samples from stored times only:

* ingestion_latency, one for each order: write time of its file in the log - its event time;
* failed_batches, one for each batch: 1 if the query failed in it, else 0;
* query_latency, one for each timed panel of the dashboard;
* processing_lag, one for each batch of the enrichment: end of the batch - newest event time;
* data_freshness, one for each batch of the window jobs: its end - newest window end published.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources.log import read_log
from tidemark.sources.upsert import fs_exists, fs_write_text

PROGRESS = ("job string, run_id string, batch_id long, started_at timestamp, ended_at timestamp, input_rows long, "
            "dropped_rows long, newest_event timestamp, newest_published timestamp, failed boolean, error string")
SAMPLES = "metric string, ts timestamp, value double"
FRESHNESS_JOBS = ("revenue_5min", "city_revenue_5min")
LAG_JOBS = ("enrich_alert",)


def observed(df: DataFrame, name: str, time_col: str) -> DataFrame:
    """``df`` with its newest ``time_col`` in the progress of the query, as ``name``."""
    return df.observe(name, F.max(F.col(time_col).cast("timestamp")).alias("newest"))


def _text(t: datetime | None) -> str | None:
    return None if t is None else t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def progress_path(root: str) -> str:
    return f"{root.rstrip('/')}/_progress/batches"


def samples_path(root: str) -> str:
    return f"{root.rstrip('/')}/_progress/samples"


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """Every recorded batch of a deployment. A batch that was run again has a row for each run."""
    path = progress_path(root)
    if not fs_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(path)


class ProgressRecorder(StreamingQueryListener):
    """Appends the progress of a deployment's queries. ``names``: query name -> job."""

    def __init__(self, spark: SparkSession, root: str, names: dict[str, str]):
        self.spark, self.root, self.names = spark, root.rstrip("/"), names
        self._running: dict[str, str] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        seen = (read_progress(spark, root).groupBy("job").agg(F.max("newest_event").cast("double").alias("e"),
                                                              F.max("newest_published").cast("double").alias("p")).collect())
        self._newest = {(r.job, kind): datetime.fromtimestamp(t, timezone.utc)
                        for r in seen for kind, t in (("input", r.e), ("output", r.p)) if t is not None}

    def _append(self, name: str, row: dict) -> None:
        fs_write_text(self.spark, f"{progress_path(self.root)}/{name}.json", json.dumps(row))

    def _seen(self, job: str, progress, kind: str) -> str | None:
        """The newest time of all batches so far: a batch of old rows does not set it back."""
        metrics = progress.observedMetrics.get(kind)
        value = metrics["newest"] if metrics is not None else None
        if value is not None:
            value = value.astimezone(timezone.utc)
            if (known := self._newest.get((job, kind))) is None or value > known:
                self._newest[job, kind] = value
        return _text(self._newest.get((job, kind)))

    def onQueryStarted(self, event) -> None:
        if event.name in self.names:
            self._running[str(event.runId)] = self.names[event.name]

    def onQueryProgress(self, event) -> None:
        p = event.progress
        job = self.names.get(p.name)
        if job is None:
            return
        start = datetime.strptime(p.timestamp, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc)
        end = start + timedelta(milliseconds=int(p.durationMs.get("triggerExecution", 0)))
        self._append(f"{p.runId}-{p.batchId}-{start:%H%M%S%f}", {
            "job": job, "run_id": str(p.runId), "batch_id": p.batchId, "started_at": _text(start), "ended_at": _text(end),
            "input_rows": p.numInputRows, "dropped_rows": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
            "newest_event": self._seen(job, p, "input"), "newest_published": self._seen(job, p, "output"), "failed": False, "error": None})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        job = self._running.pop(run, None)
        if job is not None and event.exception:
            now = _text(datetime.now(timezone.utc))
            self._append(f"{run}-failed", {"job": job, "run_id": run, "batch_id": None, "started_at": now, "ended_at": now, "failed": True,
                                           "error": event.exception[:1000]})
        with self._changed:
            self._ended.add(run)
            self._changed.notify_all()

    def wait(self, *queries, seconds: float = 60.0) -> None:
        """Until all that ended queries told has been stored (events come later than a query's end)."""
        with self._changed:
            if not self._changed.wait_for(lambda: all(str(q.runId) in self._ended for q in queries), seconds):
                raise TimeoutError("the end of a query was not reported")


def record_samples(spark: SparkSession, root: str, rows: list[tuple[str, datetime, float]]) -> None:
    """Append measured samples (metric, time, value): few at a time, as one file."""
    text = "\n".join(json.dumps({"metric": m, "ts": _text(t), "value": v}) for m, t, v in rows)
    if text:
        fs_write_text(spark, f"{samples_path(root)}/{uuid.uuid4().hex}.json", text)


def timed_queries(spark: SparkSession, root: str, queries: dict[str, DataFrame]) -> dict[str, list]:
    """Run small-result queries and record how long each took, a failed one as well."""
    out, rows = {}, []
    try:
        for name, df in queries.items():
            start = time.monotonic()
            try:
                out[name] = df.collect()
            finally:
                rows.append(("query_latency", datetime.now(timezone.utc), time.monotonic() - start))
    finally:
        record_samples(spark, root, rows)
    return out


def slo_samples(spark: SparkSession, root: str, log_path: str) -> DataFrame:
    """(metric, ts, value in seconds) of the five objectives, from stored times only."""
    seconds = lambda late, early: (F.unix_micros(late) - F.unix_micros(early)) / F.lit(1e6)
    log = read_log(spark, log_path).select("event_time", F.col("_metadata.file_modification_time").alias("ts"))
    out = log.select(F.lit("ingestion_latency").alias("metric"), "ts", seconds(F.col("ts"), F.col("event_time")).alias("value"))
    progress = read_progress(spark, root)
    done = progress.where("not failed and newest_event is not null").withColumn("ts", F.col("ended_at"))
    out = out.unionByName(progress.select(F.lit("failed_batches").alias("metric"), F.col("ended_at").alias("ts"), F.col("failed").cast("double").alias("value")))
    out = out.unionByName(done.where(F.col("job").isin(*LAG_JOBS)).select(
        F.lit("processing_lag").alias("metric"), "ts", seconds(F.col("ts"), F.col("newest_event")).alias("value")))
    out = out.unionByName(done.where(F.col("job").isin(*FRESHNESS_JOBS) & F.col("newest_published").isNotNull()).select(
        F.lit("data_freshness").alias("metric"), "ts", seconds(F.col("ts"), F.col("newest_published")).alias("value")))
    if fs_exists(spark, samples_path(root)):
        out = out.unionByName(spark.read.schema(SAMPLES).json(samples_path(root)))
    return out


def completion_delays(spark: SparkSession, root: str) -> DataFrame:
    """O3 by batch: seconds from the end of the newest window to the end of the batch that
    published it."""
    return (read_progress(spark, root).where("newest_published is not null")
            .select("job", "batch_id", "ended_at", ((F.unix_micros("ended_at") - F.unix_micros("newest_published")) / F.lit(1e6)).alias("delay_seconds")))


def dropped_rows(spark: SparkSession, root: str) -> DataFrame:
    """Groups that stateful operators dropped as late, by job, over all recorded batches."""
    return (read_progress(spark, root).groupBy("job")
            .agg(F.sum("input_rows").alias("input_rows"), F.coalesce(F.sum("dropped_rows"), F.lit(0)).alias("dropped_rows")))
