"""Point lookups in a stored table laid out by its key.

Rows are dealt to buckets by the hash of their key; a bucket is a directory, ``bucket_of_N=b``,
and rows are sorted by key in its files. The bucket of a sought key is a constant, so a lookup
reads one directory (a partition filter) and, by the key's smallest and largest value of each row
group, little of it. N stands in the directories' name: reading needs no other metadata, and no
count. A hot or NULL key's bucket is written by several tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.log import spread_by_day
from tidemark.sources.upsert import fs_list

PREFIX = "bucket_of_"
ROWS_PER_BUCKET = 1_000_000


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, key: str, buckets: int | None = None,
                rows_per_file: int = ROWS_PER_BUCKET) -> int:
    """Write ``df`` by the buckets of ``key``; returns their number, which follows the rows."""
    n = buckets or max(1, math.ceil(df.count() / ROWS_PER_BUCKET))
    name = f"{PREFIX}{n}"
    dealt = spread_by_day(df.withColumn(name, bucket_of(F.col(key), n)), name, rows_per_file)
    dealt.sortWithinPartitions(name, key).write.partitionBy(name).parquet(path)
    return n


def _bucket_column(spark: SparkSession, path: str) -> str | None:
    names = {n.split("=")[0] for n in fs_list(spark, path) if n.startswith(PREFIX)}
    if len(names) > 1:
        raise ValueError(f"{path} holds several layouts: {sorted(names)}")
    return names.pop() if names else None


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole table."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def lookup(spark: SparkSession, path: str, schema: T.StructType, key: str, *values) -> DataFrame:
    """The rows whose key is one of ``values`` (None: the rows without a key)."""
    name = _bucket_column(spark, path)
    if name is None or not values:
        return spark.createDataFrame([], schema)
    n = int(name.removeprefix(PREFIX))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(name, T.IntegerType())])).parquet(path)
    known, kind = [v for v in values if v is not None], schema[key].dataType
    lits = [F.lit(v).cast(kind) for v in known]
    among = F.col(key).isin(lits) if lits else F.lit(False)
    if len(known) < len(values):
        among = among | F.col(key).isNull()
        lits.append(F.lit(None).cast(kind))
    return rows.where(F.col(name).isin([bucket_of(v, n) for v in lits])).where(among).select(*schema.fieldNames())
