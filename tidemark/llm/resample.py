"""Importance resampling towards a target, with features of lines counted once.

Features are hashed runs of one and two words. How much likelier a bucket is in the target than
in the raw corpus is its gain; a document's weight is the mean gain of its features, and a draw
without replacement keeps the highest sums of weight and Gumbel noise.

1. Segments. Newlines cut texts into lines, and no word crosses one. Lines are grouped over the
   whole corpus (partial sums first, so that a line in a third of all texts is one row of each
   task); the buckets of each distinct line are worked out once and written, with the number of
   its occurrences. A document is written as the digests of its lines, and the buckets of the
   pairs of words that stand across newlines.
2. Counts. A bucket's count is the sum over distinct lines of its features times the line's
   occurrences, plus the pairs across newlines, which are counted on their own.
3. Gains. One number for each bucket: a bounded table.
4. Weights. Features and gains are summed once for each distinct line; documents then add up the
   sums of their lines (a join on the line's 128-bit digest, which Spark splits where a line is
   hot) and the gains across newlines. Whole texts are never shuffled; lines are, once.
5. Draw. Ranks are running totals over ranges of the order (``operators.ordered``), so that no
   task sees the whole order.

Defined results: a null or empty text, or one without words, has no features and weight 0 and is
not drawn; null ids are hashed as no digits and come last among ties; rows with equal id and text
are equal but for their rank, and share no rank; very long texts and lines are rows like others;
an empty table gives no rows, an empty target counts 0; extra columns are not read, and kept by
``resample``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col, documents, fresh, ship
from tidemark.llm.words import SLICE_BYTES, sliced, texts_of
from tidemark.operators.ordered import running_total

#: Fixed value: a word's characters by code points, and the capitals that count as small letters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Hash buckets of the features; percent of the documents drawn; least words of these; the seed.
BUCKETS, PERCENT, LEAST, SEED = 10000, 25, 20, 7

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Equal rows are given out in runs of so many.
RUN = 1 << 16


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature) % buckets).cast("int")


def segments(text: Column) -> Column:
    """The lines of a text that have words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD)))


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def skeletons(df: DataFrame, text: Column, buckets: int) -> DataFrame:
    """``df`` with the digests of its lines, and the buckets of the pairs of words across them."""
    lines, first, last = fresh(df, "lines", "first", "last")
    word = lambda line: F.translate(F.regexp_extract(line, f"{WORD}+", 0), UPPER, LOWER)
    df = df.withColumn(lines, segments(text))
    df = df.withColumn(first, F.transform(lines, word)).withColumn(last, F.transform(lines, lambda line: F.reverse(word(F.reverse(line)))))
    ends = F.slice(last, F.lit(1), F.greatest(F.size(last) - 1, F.lit(0)))
    pairs = F.zip_with(ends, F.slice(first, F.lit(2), F.size(first)), lambda a, b: bucket(F.concat_ws(" ", a, b), buckets))
    return df.withColumn("lines", F.transform(lines, digest)).withColumn("pairs", pairs).drop(lines, first, last)


# ---- features of many lines at once ------------------------------------------------------------

# Bytes to what they count as: letters to small ones, all that is in no word to spaces.
_AS = np.full(256, 32, np.uint8)
_AS[48:58], _AS[97:123], _AS[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_AS[65:91] = np.arange(97, 123)
#: The checksum of each byte after a checksum of zeros, by its rule (reflected polynomial).
_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, _TABLE >> 1 ^ np.uint32(0xEDB88320), _TABLE >> 1).astype(np.uint32)
#: Longer words are summed one by one.
LONG = 48


def checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """crc32 of data[start : start + size], each going on from the checksum ``ahead``."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    state = ~ahead[order]
    some = int(np.searchsorted(-left, -LONG, "left"))  # the ones over LONG stand first
    now, at = state[some:], at[some:]
    for j in range(int(left[some]) if some < len(left) else 0):
        k = int(np.searchsorted(-left[some:], -j, "left"))
        now[:k] = _TABLE[(now[:k] ^ data[at[:k] + j]) & 255] ^ now[:k] >> 8
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in order[:some]:
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]], int(ahead[i]))
    return out


def features(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of neighbours in lines that begin and end at ``bounds``,
    line by line, and how many each line has."""
    data = _AS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    word = data != 32
    start = np.flatnonzero(word & (np.append(True, ~word[:-1]) | edge[:-1]))
    end = np.flatnonzero(word & (np.append(~word[1:], True) | edge[1:])) + 1
    line = np.searchsorted(bounds, start, "right") - 1
    one = checksums(data, start, end - start, np.zeros(len(start), np.uint32))
    pair = np.flatnonzero(line[1:] == line[:-1])
    space = ~(_TABLE[(~one[pair] ^ 32) & 255] ^ ~one[pair] >> 8)
    two = checksums(data, start[pair + 1], (end - start)[pair + 1], space)
    of = np.concatenate([line, line[pair]])
    order = np.argsort(of, kind="stable")
    return (np.concatenate([one, two]) % buckets)[order].astype(np.int32), np.bincount(of, minlength=len(bounds) - 1)


def _features(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = texts_of(batch.column(2))
        for i, j in sliced(at, SLICE_BYTES):
            found, many = features(data[at[i] : at[j]], at[i : j + 1] - at[i], buckets)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], lists], names=["line", "times", "buckets"])


def lines_of(texts: DataFrame, buckets: int) -> DataFrame:
    """Distinct lines of ``texts`` (a column ``text``): digest, occurrences, buckets of all their
    features, repeats included."""
    ship(texts.sparkSession)
    lines = texts.select(F.explode(segments(F.col("text"))).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    return (lines.select(digest(F.col("line")).alias("digest"), "times", "line")
            .mapInArrow(lambda rows: _features(rows, buckets), "line binary, times bigint, buckets array<int>"))


def counts(lines: DataFrame, skeleton: DataFrame) -> DataFrame:
    """(bucket, n) over all texts: lines times their occurrences, and pairs across lines."""
    inside = lines.select("times", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("times").alias("n"))
    between = skeleton.select(F.explode("pairs").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return inside.union(between).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of every bucket, from two tables (bucket, n) of at most ``buckets`` rows each."""
    spark = raw.sparkSession
    both = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    total = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    real = lambda c, more: (c + F.lit(more)).cast("double")
    ratio = (real(F.col("t"), 1) * real(F.lit(total.S), buckets)) / (real(F.col("s"), 1) * real(F.lit(total.T), buckets))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("g")).collect()  # bounded by the parameter
    return [r.g for r in sorted(rows)]


def gained(features: str | Column, table: list[int]) -> Column:
    """The sum of the gains of an array of buckets."""
    values = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    return F.aggregate(features, F.lit(0).cast("bigint"), lambda total, b: total + F.get(values, b))


def noise(doc_id: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def importance(df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
               least: int = LEAST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row for each different (doc_id, text) of ``df``: doc_id, hash of the text, copies,
    n_features, weight, score, and last: the rank of the last copy (null: too few words), and
    drawn: how many of its copies are among the draw."""
    spark = df.sparkSession
    scratch = Scratch(spark, "resample")
    texts = df.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("hash"), col(text).alias("text"))
    lines = scratch.save(lines_of(texts, buckets))
    skeleton = scratch.save(skeletons(texts, F.col("text"), buckets).drop("text"))
    wanted = target.select(col(target_text).alias("text"))
    table = gains(counts(lines, skeleton), counts(lines_of(wanted, buckets), skeletons(wanted, F.col("text"), buckets)), buckets)

    known = scratch.save(lines.select("line", F.size("buckets").alias("f"), gained("buckets", table).alias("g")))
    scratch.drop(lines)
    inside = (skeleton.select("doc_id", "hash", F.explode("lines").alias("line")).join(known, "line")
              .select("doc_id", "hash", "f", "g", F.lit(0).alias("copies")))
    between = skeleton.select("doc_id", "hash", F.size("pairs").alias("f"), gained("pairs", table).alias("g"), F.lit(1).alias("copies"))
    summed = inside.union(between).groupBy("doc_id", "hash").agg(F.sum("f").alias("f"), F.sum("g").alias("g"), F.sum("copies").alias("copies"))
    weight = F.when(F.col("f") > 0, F.expr("(g - pmod(g, f)) div f")).otherwise(0)
    each = summed.select("doc_id", "hash", "copies", F.expr("f div copies").alias("f"), F.expr("g div copies").alias("g"))
    scored = scratch.save(each.select("doc_id", "hash", "copies", F.col("f").alias("n_features"), weight.cast("bigint").alias("weight"))
                          .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))

    enough = F.col("n_features") >= 2 * least - 1  # n words have 2n - 1 features
    n = scored.where(enough).agg(F.sum("copies")).first()[0] or 0
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("hash").asc()]
    ranked = running_total(scored.where(enough), order, "copies", "last")
    drawn = F.greatest(F.lit(0), F.least("copies", F.lit(percent * n // 100) - F.col("last") + F.col("copies")))
    return ranked.withColumn("drawn", drawn).unionByName(
        scored.where(~enough).withColumn("last", F.lit(None).cast("bigint")).withColumn("drawn", F.lit(0).cast("bigint")))


def spread(found: DataFrame) -> DataFrame:
    """One row for each copy, with its rank among the draw; runs of copies keep arrays short."""
    runs = found.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {RUN}"))))
    at = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN + 1, F.least("copies", (F.col("run") + 1) * RUN))))
    return at.withColumn("rank", F.when(F.col("copy") <= F.col("drawn"), F.col("last") - F.col("copies") + F.col("copy"))).drop("run", "copy")


def resample(df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **law) -> DataFrame:
    """The rows of ``df`` that are drawn. Of rows with equal id and text that are drawn in part
    (there is one such group at most, at the end of the draw), any are taken."""
    found = Scratch(df.sparkSession, "drawn").save(importance(df, target, doc_id, text, **law))
    i, h = fresh(df, "id", "hash")
    rows = df.withColumn(h, F.xxhash64(col(text)))
    whole = found.where("drawn = copies").select(F.col("doc_id").alias(i), F.col("hash").alias(h))
    out = rows.join(whole.withColumnRenamed(h, f"{h}_"), (F.col(h) == F.col(f"{h}_")) & col(doc_id).eqNullSafe(F.col(i)), "left_semi")
    for r in found.where("drawn > 0 and drawn < copies").collect():
        out = out.union(rows.where((F.col(h) == r.hash) & col(doc_id).eqNullSafe(F.lit(r.doc_id))).limit(r.drawn))
    return out.drop(h)


def op13_line_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return spread(found).select("doc_id", "n_features", "weight", "score", "rank")
