"""Late rows as a side output of a windowed job, and their exact running count.

The query is a union of the windowed aggregate and the rows it reads, so that each micro-batch
hands both to ``foreachBatch``: the windows that closed, and the batch's own rows. A window drops
the rows that come after the watermark of the batch before had passed its end. That watermark is
the newest event time of the batches up to then, less the delay; the newest time of each batch is
stored with its counts, below ``_late`` of the deployment, so it is known after a restart, and a
batch that runs again decides and writes the same. So every logged row of a closed window is
either in a published window or in the late table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.windows import window_seconds
from tidemark.sources.upsert import fs_exists, fs_write_text

COUNTS = "batch_id long, input_rows long, late_rows long, newest_us long, total_rows long, total_late long"


def _paths(root: str, job: str) -> tuple[str, str]:
    return f"{root}/_late/{job}", f"{root}/late_orders/job={job}"


class LateSplitter:
    """Keeps, for one query, the watermark that its windows went by in each batch."""

    def __init__(self, spark: SparkSession, root: str, job: str, source: str, width: str, delay: str):
        counts, self.rows_path = _paths(root, job)
        self.spark, self.source, self.counts = spark, source, f"{counts}/source={source}"
        self.width, self.delay_ms = width, window_seconds(delay) * 1000
        self._last = None      # (batch id, newest before it, newest through it, rows and late rows through it)

    def _before(self, batch_id: int) -> tuple[int | None, int | None, int, int]:
        """Newest event time (ms) up to the batch before last, and up to the last; rows and late
        rows so far."""
        if self._last is None or self._last[0] != batch_id - 1:
            stored = self.spark.read.schema(COUNTS).json(self.counts) if fs_exists(self.spark, self.counts) else self.spark.createDataFrame([], COUNTS)
            r = stored.where(F.col("batch_id") < batch_id).agg(
                F.max(F.when(F.col("batch_id") < batch_id - 1, F.col("newest_us"))), F.max("newest_us"), F.sum("input_rows"), F.sum("late_rows")).first()
            return tuple(None if t is None else t // 1000 for t in r[:2]) + (r[2] or 0, r[3] or 0)
        return self._last[1:]

    def split(self, rows: DataFrame, batch_id: int) -> None:
        """Write the late ones of a batch's rows, and count all."""
        earlier, newest, total, total_late = self._before(batch_id)
        end = F.unix_micros(F.window("event_time", self.width).end)
        late = F.lit(False) if earlier is None else end <= F.lit((earlier - self.delay_ms) * 1000)
        tagged = rows.withColumn("_late", F.coalesce(late, F.lit(False)))
        tagged.where("_late").drop("_late").write.mode("overwrite").parquet(f"{self.rows_path}/source={self.source}/batch_id={batch_id}")
        c = tagged.agg(F.count("*").alias("n"), F.count_if("_late").alias("late"), F.max(F.unix_micros("event_time")).alias("newest")).first()
        total, total_late = total + c.n, total_late + c.late
        fs_write_text(self.spark, f"{self.counts}/{batch_id}.json", json.dumps({
            "batch_id": batch_id, "input_rows": c.n, "late_rows": c.late, "newest_us": c.newest, "total_rows": total, "total_late": total_late}))
        times = [t for t in (newest, None if c.newest is None else c.newest // 1000) if t is not None]
        self._last = (batch_id, newest, max(times, default=None), total, total_late)


def with_rows(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """One stream of both: ``window`` or ``row`` is set."""
    w, r = F.struct(*windows.columns), F.struct(*rows.columns)
    kinds = windows.select(w.alias("x")).schema["x"].dataType, rows.select(r.alias("x")).schema["x"].dataType
    return windows.select(w.alias("window"), F.lit(None).cast(kinds[1]).alias("row")).union(
        rows.select(F.lit(None).cast(kinds[0]).alias("window"), r.alias("row")))


def late_orders(spark: SparkSession, root: str, job: str) -> DataFrame:
    """The late rows of a job, each once."""
    return spark.read.parquet(_paths(root, job)[1]).drop("source", "batch_id")


def late_counts(spark: SparkSession, root: str, job: str) -> DataFrame:
    """Q9 by batch: rows, late rows, and their totals up to it."""
    return spark.read.schema(COUNTS).json(_paths(root, job)[0])


def late_rate(spark: SparkSession, root: str, job: str) -> DataFrame:
    """Q9: late rows of all rows, over every batch that the job has run."""
    c = late_counts(spark, root, job).agg(F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"), F.coalesce(F.sum("input_rows"), F.lit(0)).alias("total_rows"))
    return c.withColumn("late_rate", F.when(F.col("total_rows") > 0, F.col("late_rows").cast("double") / F.col("total_rows")))
