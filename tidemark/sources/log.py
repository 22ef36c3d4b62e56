"""The append-only, day-partitioned order log on Parquet.

Batch writes append new files under ``event_day=...`` directories; the streaming writer is
Spark's file sink, whose metadata log makes a replayed micro-batch idempotent. Readers always
pass the declared schema: partitions removed by retention, or columns added later (read as
NULL in old files), never break a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas


DEFAULT_ROWS_PER_FILE = 2_000_000


def spread_by_day(df: DataFrame, day_col: str = "event_day",
                  rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> DataFrame:
    """Cluster rows by day for partitioned writes without letting a hot day land in one task.

    A per-day row count (one row per day, so bounded by retention, broadcast) gives each day
    ceil(rows / rows_per_file) files; rows are hashed to one of their day's slots and the
    shuffle is on (day, slot). A day holding a third of all rows is written by many tasks.
    """
    from pyspark.sql import functions as F
    sizes = (df.groupBy(day_col).agg(F.count(F.lit(1)).alias("_n"))
             .select(day_col, F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(rows_per_file)))
                     .cast("long").alias("_files")))
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files"))
    return (df.join(F.broadcast(sizes), day_col, "left")
            .withColumn("_slot", slot).repartition(day_col, "_slot")
            .drop("_slot", "_files").select(*df.columns))


def append_log(df: DataFrame, path: str, partition: str = "event_day",
               rows_per_file: int | None = None) -> None:
    """Append a batch. With ``rows_per_file`` rows are clustered by day (few files per day,
    hot days split over several tasks, see ``spread_by_day``)."""
    out = spread_by_day(df, partition, rows_per_file) if rows_per_file else df
    out.write.mode("append").partitionBy(partition).parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType = schemas.ORDERS_RAW,
             streaming: bool = False, max_files_per_trigger: int | None = None,
             partition: str = "event_day") -> DataFrame:
    """Batch or streaming read with an explicit schema (partition column included). Days that
    retention removes while a read runs do not fail it; no other reader tolerates lost files.

    The reader gets the partition column last: that is where it puts the columns that it finds
    in paths, and a stream that starts on an empty log finds them only later."""
    columns = schema.fieldNames()
    fields = sorted(schema.fields, key=lambda f: f.name == partition)
    reader = (spark.readStream if streaming else spark.read).schema(T.StructType(fields)).option("ignoreMissingFiles", "true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = reader.parquet(path)
    return out if [f.name for f in fields] == columns else out.select(*columns)


def start_log_writer(stream: DataFrame, path: str, checkpoint: str, partition: str = "event_day",
                     trigger: dict | None = None):
    """Streaming append into the log through the file sink (exactly-once via its metadata)."""
    w = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy(partition).outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
