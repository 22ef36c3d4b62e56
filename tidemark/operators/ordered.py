"""Running sums, ranks and percentiles over a whole series, without ordering it in one task.

A distributed prefix sum has three steps: rows are dealt to ranges of the order (sampled splitters)
and written, each range is summed, and within its range a row adds the sums of the ranges before
to its own running sum. Only one number for each range, at most ``ranges``, passes the driver.
A range holds all rows with equal keys, so ties should be grouped first (``value`` then is
their total), or the order should end in columns that tell rows apart.

The written ranges cut lineage: a lost executor cannot deal rows to other ranges than before.

A percentile needs no order at all. The values of a group are counted in bins between their
smallest and largest one; the bin that holds the wanted rank is divided again, until its
smallest and largest value are the same. Each pass is one grouped aggregate with partial sums.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

_RANGE, _TOTAL, _BEFORE = "_range", "_total", "_before"


def ranged(df: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``order``, and read again, with the column ``_range``."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{scratch_dir(spark, 'ranges')}/rows"
    df.repartitionByRange(n, *order).withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    schema = df.withColumn(_RANGE, F.lit(0)).schema
    return spark.read.schema(schema).parquet(path)


def running_total(df: DataFrame, order: list[Column], value: str | Column, name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (an integer) over all rows up to this one, null
    values counting as nothing."""
    value = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0)).cast("bigint")
    rows = ranged(df.withColumn(_TOTAL, value), order, ranges)
    sums = sorted(rows.groupBy(_RANGE).agg(F.sum(_TOTAL).alias("s")).collect())  # one row for each range
    before = list(accumulate((s.s for s in sums), initial=0))
    offsets = df.sparkSession.createDataFrame([(s[_RANGE], b) for s, b in zip(sums, before)], f"{_RANGE} int, {_BEFORE} bigint")
    within = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(F.broadcast(offsets), _RANGE)
            .withColumn(name, F.sum(_TOTAL).over(within) + F.col(_BEFORE)).drop(_RANGE, _TOTAL, _BEFORE))


BINS = 1024


def nearest_rank(df: DataFrame, group: str, value: str, share: float, bins: int = BINS) -> dict:
    """{group: the value of rank ceil(share * n) among its n values}: exact, one of the values.

    Null values do not count; a group without others is left out; infinite values and NaN are an
    error. Groups are few: at most groups x bins counts come to the driver in each pass. A pass
    divides a group's range of values by ``bins``, and always parts its two ends."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, 'ranks')}/values"
    df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null").write.parquet(path)
    rows = spark.read.schema("g string, v double").parquet(path) if dict(df.dtypes)[group] == "string" else spark.read.parquet(path)
    found, todo = {}, {}
    for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect():
        if not (math.isfinite(r.low) and math.isfinite(r.high)):
            raise ValueError(f"values of {r.g!r} are not finite")
        todo[r.g] = (max(1, math.ceil(r.n * share)), r.low, r.high)
    while True:
        found.update({g: low for g, (_, low, high) in todo.items() if low == high})
        todo = {g: t for g, t in todo.items() if t[1] < t[2]}
        if not todo:
            return found
        # Halves where the range itself is beyond the largest number.
        bounds = [(g, low, high, 1.0 if math.isfinite(high - low) else 0.5) for g, (_, low, high) in todo.items()]
        ends = F.broadcast(spark.createDataFrame(bounds, rows.select(F.col("g").alias("k")).schema.add("low", "double").add("high", "double").add("f", "double")))
        part = (F.col("v") * F.col("f") - F.col("low") * F.col("f")) / (F.col("high") * F.col("f") - F.col("low") * F.col("f"))
        counted = (rows.join(ends, F.col("g").eqNullSafe(F.col("k"))).where("v between low and high")
                   .groupBy("g", F.least(F.lit(bins - 1), F.floor(part * bins)).alias("bin"))
                   .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
        by = {}
        for r in sorted(counted, key=lambda r: r.bin):
            by.setdefault(r.g, []).append(r)
        for g, (rank, _, _) in todo.items():
            for r in by[g]:
                if rank <= r.n:
                    todo[g] = (rank, r.low, r.high)
                    break
                rank -= r.n
