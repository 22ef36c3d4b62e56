"""L8 on the live log: purged keys are joined away on read, and leave the files later.

A log that a stream writes cannot be rewritten: the sink's metadata names its files. So a purge
appends the key to a list beside the log, in force at once for all readers that go through
``without`` (an anti join). Files follow where a batch job owns them: the tier run copies days to
cold without purged rows, cold days that hold such rows are rewritten, and hot days go when they
are tiered and old. ``remaining`` tells by day what is still in files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import bounded_broadcast
from tidemark.sources.upsert import fs_exists

KEYS = "column string, value string, purged_at timestamp"


def purge(spark: SparkSession, list_path: str, column: str, keys: DataFrame | list[str]) -> None:
    """Add keys (a one-column frame, or a few values) to the list. NULL is no key."""
    if not isinstance(keys, DataFrame):
        keys = spark.createDataFrame([(k,) for k in keys], "value string")
    (keys.toDF("value").where("value is not null").distinct()
     .select(F.lit(column).alias("column"), F.col("value").cast("string"), F.current_timestamp().alias("purged_at"))
     .write.mode("append").parquet(list_path))


def purged(spark: SparkSession, list_path: str, column: str) -> DataFrame:
    """The purged values of a column, each once."""
    if not fs_exists(spark, list_path):
        return spark.createDataFrame([], "value string")
    return spark.read.schema(KEYS).parquet(list_path).where(F.col("column") == column).select("value").distinct()


def without(df: DataFrame, list_path: str, column: str = "customer_id") -> DataFrame:
    """``df`` without the rows of purged keys; rows without a key stay. The list as of the call
    counts (a stream's caller asks anew for each batch)."""
    if not fs_exists(df.sparkSession, list_path):
        return df
    keys = bounded_broadcast(purged(df.sparkSession, list_path, column).withColumnRenamed("value", "_purged"))
    return df.join(keys, F.col(column).cast("string") == F.col("_purged"), "left_anti")


def remaining(df: DataFrame, list_path: str, column: str = "customer_id", day_col: str = "event_day") -> DataFrame:
    """Rows of purged keys by day, of a frame that still has them."""
    keys = bounded_broadcast(purged(df.sparkSession, list_path, column).withColumnRenamed("value", "_purged"))
    return (df.join(keys, F.col(column).cast("string") == F.col("_purged"), "left_semi")
            .groupBy(day_col).agg(F.count(F.lit(1)).alias("rows")))
