"""Sharding by sampled splitters: shards of nearly equal bytes, groups of equal texts together.

1. A narrow row per record (key, size) is written once; the texts are read for that alone.
2. Keys are drawn with a chance in proportion to their record's size, about ``DRAWS`` for each
   range; their quantiles are the splitters of many more ranges than shards. The key is the
   text's hash, then the record id; a splitter is cut back to the text's hash unless the same
   text fills a whole range by itself, so that equal texts share a range.
3. Records are put into ranges and each range's bytes and rows are counted exactly. Ranges that
   hold more than ``OVERFULL`` times the mean because of one text are cut again inside that text
   (by record id), and only then may a group of equal texts lie in two shards: if it would
   overfill one.
4. Ranges go to the shards, the largest first, each to the shard with the fewest bytes.
5. A record's slot is its range's offset in the shard plus its rank in the range, so that no
   task ever orders more than one range.

What reaches the driver: the drawn keys and one row per range. The number of ranges is
``RANGES`` times the shards, or more where ranges would hold over ``RANGE_ROWS`` rows.

Defined results: a null text has no bytes, the checksum 0 and its own group; null ids order
first; repeated rows are records of their own, any of them may get any of their slots; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents

#: Ranges for each shard, keys drawn for each range, rows of a range from which there are more.
RANGES, DRAWS, RANGE_ROWS = 32, 48, 1_000_000

#: A group of equal texts is cut only if it holds more than this share of a shard's bytes.
OVERFULL = 1.04

#: Bytes that a record takes besides its text.
FIXED = 8


def keyed(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The narrow rows: id, size, checksum, and the key (text's hash, id's hash)."""
    t = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return df.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(t) + F.lit(FIXED)).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("k1"),
        F.xxhash64(F.lit("record"), F.col(doc_id)).alias("k2"),
    )


def splitters(rows: DataFrame, total: int, ranges: int) -> pd.DataFrame:
    """Quantiles of a size-weighted sample of the keys, as (k1, k2) in order."""
    want = ranges * DRAWS
    chance = F.col("size") * (want / total)
    unit = (F.xxhash64(F.lit("draw"), "k1", "k2").bitwiseAND((1 << 52) - 1)) / float(1 << 52)
    drawn = (rows.where(unit < chance).select("k1", "k2", F.greatest(F.lit(1.0), chance).alias("w"))
             .toPandas().sort_values(["k1", "k2"], ignore_index=True))
    if drawn.empty:
        return drawn[["k1", "k2"]]
    reach = drawn["w"].cumsum().to_numpy()
    at = np.searchsorted(reach, reach[-1] * np.arange(1, ranges) / ranges)
    cut = drawn.loc[at, ["k1", "k2"]].reset_index(drop=True)
    lowest = np.iinfo(np.int64).min
    hot = set(cut["k1"][cut["k1"].duplicated()])  # texts that fill a range by themselves
    inner = cut[cut["k1"].isin(hot)]
    edges = pd.concat([cut.assign(k2=lowest), inner] + [
        pd.DataFrame({"k1": [k + 1], "k2": [lowest]}) for k in hot if k < np.iinfo(np.int64).max])
    return edges.drop_duplicates().sort_values(["k1", "k2"], ignore_index=True)


def range_of(cut: pd.DataFrame):
    """A column function: the number of splitters at or below a key."""
    # Structured comparison in one pass: ranks of k1 first, k2 among equal k1.
    k1, k2 = cut["k1"].to_numpy(np.int64), cut["k2"].to_numpy(np.int64)

    @F.pandas_udf("int")
    def find(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = a.to_numpy(np.int64), b.to_numpy(np.int64)
        low, high = np.searchsorted(k1, x, "left"), np.searchsorted(k1, x, "right")
        out = high.copy()
        for i in np.flatnonzero(high - low > 0):
            out[i] = low[i] + np.searchsorted(k2[low[i] : high[i]], y[i], "right")
        return pd.Series(out.astype(np.int32))

    return find


def packed(sums: pd.DataFrame, cut: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Ranges to shards. Ranges inside one text stay together while a shard can take them."""
    share = sums["bytes"].sum() / shards
    low = cut["k1"].to_numpy()
    left = [None if r == 0 else low[r - 1] for r in sums["range"]]
    inner = set(cut["k1"][cut["k1"].duplicated()])
    own = [k if k in inner else None for k in left]  # the text that fills the range
    size = sums["bytes"].tolist()
    units = [(size[i], [i]) for i in range(len(size)) if own[i] is None]
    for text in sorted(inner):
        same = [i for i in range(len(size)) if own[i] == text]
        whole = sum(size[i] for i in same)
        units += [(whole, same)] if whole <= OVERFULL * share else [(size[i], [i]) for i in same]
    heap, shard = [(0, s) for s in range(shards)], np.zeros(len(sums), int)
    for held, members in sorted(units, key=lambda u: (-u[0], u[1])):
        filled, s = heapq.heappop(heap)
        shard[members] = s
        heapq.heappush(heap, (filled + held, s))
    sums = sums.assign(shard=shard).sort_values(["shard", "range"])
    sums["offset"] = sums.groupby("shard")["rows"].cumsum() - sums["rows"]
    return sums[["range", "shard", "offset"]]


def shard_records(df: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot) for every record of ``df``."""
    spark = df.sparkSession
    rows = Scratch(spark, "sharding").save(keyed(df, doc_id, text))
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(shards * RANGES, -(-count // RANGE_ROWS))
    cut = splitters(rows, total, ranges)
    placed = rows.withColumn("range", range_of(cut)("k1", "k2"))
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    plan = packed(sums.toPandas().sort_values("range", ignore_index=True), cut, shards)
    plan = spark.createDataFrame(plan, "range int, shard int, offset long")
    rank = F.row_number().over(Window.partitionBy("range").orderBy("k1", "k2", "size"))
    return (placed.withColumn("rank", rank).join(F.broadcast(plan), "range")  # one row per range
            .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot")))


def write_shards(df: DataFrame, path: str, shards: int = 24) -> None:
    """Writes the records themselves, one folder per shard, rows of a shard in slot order within
    each file. Needs ids without nulls or repetitions."""
    place = shard_records(df, shards).select(F.col("doc_id").alias("_llm_id"), "shard", "slot")
    out = df.join(place, df["doc_id"] == F.col("_llm_id")).drop("_llm_id")
    files = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (out.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op7_sampled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
