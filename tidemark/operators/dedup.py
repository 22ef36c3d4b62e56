"""X11: de-duplication of replayed orders.

Batch: the newest copy of each key, by one aggregate with map-side partial aggregation, so that
even a key repeated millions of times is collapsed inside each task before the shuffle.
Streaming: ``dropDuplicatesWithinWatermark`` keeps one row per key while the key may still
arrive (state bounded by the watermark delay, e.g. 1 hour). It also drops first copies that
arrive later than that; a job that may lose none uses ``first_copies`` on its micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_orders(df: DataFrame, keys=("order_id",), within: str = "1 hour",
                 time_col: str = "event_time") -> DataFrame:
    keys = list(keys)
    if df.isStreaming:
        return df.withWatermark(time_col, within).dropDuplicatesWithinWatermark(keys)
    from tidemark.sources.upsert import latest_per_key
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    return latest_per_key(tied, keys, [time_col, "_tie"]).select(*df.columns)


def first_copies(batch: DataFrame, seen: DataFrame, key: str, within: str,
                 time_col: str = "event_time", day_col: str = "event_day") -> DataFrame:
    """The rows of a micro-batch that are the first copy of their key: the oldest one in the
    batch, unless ``seen`` (key, time, day) holds one within the horizon. Only the days of
    ``seen`` that the horizon reaches are read (two values come to the driver)."""
    from tidemark.sources.upsert import latest_per_key
    span = F.expr(f"INTERVAL {within}")
    low, high = batch.agg(F.min(F.col(time_col) - span), F.max(F.col(time_col) + span)).first()
    aged = (batch.withColumn("_age", -F.unix_micros(F.col(time_col).cast("timestamp")))
            .withColumn("_tie", F.xxhash64(*[F.col(c) for c in batch.columns])))
    first = latest_per_key(aged, [key], ["_age", "_tie"]).select(*batch.columns)
    if low is None:
        return first
    days = seen.where((F.col(day_col) >= f"{low:%Y%m%d}") & (F.col(day_col) <= f"{high:%Y%m%d}")).select(
        F.col(key).alias("_key"), F.col(time_col).alias("_time"))
    near = (F.col(time_col) - span <= F.col("_time")) & (F.col("_time") <= F.col(time_col) + span)
    return first.join(days, (F.col(key) == F.col("_key")) & near, "left_anti")
