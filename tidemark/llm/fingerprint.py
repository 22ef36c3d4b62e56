"""Document fingerprints: one-permutation MinHash, densified, packed, with DataFrame functions only.

A text's shingles are its runs of five words (lower case; a shorter text is one shingle). Each
is hashed once. The hash's upper bits choose one of 128 bins, a bin keeps its smallest hash. An
empty bin borrows from a filled one: each bin has a random order of all bins of its own, and the
first filled bin in that order lends its value, so that two texts borrow alike as often as they
are alike. The fingerprint is the lowest 8 bits of each bin's value, as 256 hexadecimal digits.
Two different values agree in 8 bits by chance once in 256; likeness corrects for that:
(m - 1/256) / (1 - 1/256) for a fraction m of equal bins, cut to 0 to 1.

Next documents are found on rows without texts, ordered by ranges of ids: the follower within a
range by a window over that range, and over range ends from the table of the ranges' first rows.
Texts are then moved once, to be joined with their followers, and a follower moves only the part
that replaces the end of its predecessor.

Defined results: a null text counts as empty; texts without words have an empty fingerprint,
wholly like each other (1) and unlike all others (0); null ids come first; repeated rows follow
one another; rows with equal ids go by the hash of their text; a single document follows itself;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col, documents, fresh

#: Words of a shingle; bins as a power of two; low-order bits kept of each (two hex digits).
WORDS, BIN_BITS, KEPT = 5, 7, 8

BINS = 1 << BIN_BITS
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def _bin(value: Column) -> Column:
    """The bin of a hash; it grows with the hash, so that sorted hashes have sorted bins."""
    return F.shiftright(value, 64 - BIN_BITS) + BINS // 2


def with_bins(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the kept bits of every bin, as an array of longs (empty for a text without words)."""
    w, h, least, spread = fresh(df, "words", "hashes", "least", "spread")
    df = df.withColumn(w, F.split(F.btrim(F.lower(F.coalesce(col(text), F.lit(""))), F.lit(SPACE)), "[\\x20\\x09-\\x0D]+"))
    words = F.col(w)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - WORDS)),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]))
    df = df.withColumn(h, F.when(F.get(words, F.lit(0)) == "", F.array().cast("array<bigint>")).otherwise(F.sort_array(runs))).drop(w)
    hashes = F.col(h)
    df = df.withColumn(least, F.filter(hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(hashes, i - 1))))).drop(h)
    # One entry for each bin: its own smallest hash, or that of the filled bin before it.
    mins = F.col(least)
    follows = lambda i: F.coalesce(_bin(F.get(mins, i + 1)), F.lit(BINS).cast("bigint"))
    begins = lambda x, i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(_bin(x))
    df = df.withColumn(spread, F.flatten(F.transform(mins, lambda x, i: F.array_repeat(x, (follows(i) - begins(x, i)).cast("int")))))
    line = F.col(spread)

    def kept(value, j):
        # For an empty bin, each filled bin's place in this bin's order, and the bin's number in
        # the lowest bits: the least one names the lender.
        lender = F.array_min(F.transform(mins, lambda y: F.xxhash64(j, _bin(y)).bitwiseAND(-BINS).bitwiseOR(_bin(y))))
        lent = F.get(line, lender.bitwiseAND(BINS - 1).cast("int"))
        return F.when(_bin(value) == j, value).otherwise(lent).bitwiseAND((1 << KEPT) - 1)

    return df.withColumn(out, F.transform(line, kept)).drop(least, spread)


def packed(bins: Column) -> Column:
    """The kept bits of all bins as one hexadecimal string."""
    return F.lower(F.array_join(F.transform(bins, lambda x: F.lpad(F.hex(x), KEPT // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints."""
    digits, chance = KEPT // 4, 1.0 / (1 << KEPT)
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)),
                           lambda i: F.substr(a, i * digits + 1, F.lit(digits)) == F.substr(b, i * digits + 1, F.lit(digits))))
    estimate = (same / BINS - chance) / (1.0 - chance)
    return (F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), estimate))))


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of a text column."""
    bins, = fresh(df, "bins")
    return with_bins(df, text, bins).withColumn(out, packed(F.col(bins))).drop(bins)


def followers(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (doc_id, k, n), k naming equal rows, to one row for each k with its id, its number of
    rows ``copies``, the next row's ``next_k``, and ``before_k``, ``before_n`` of the one before."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = rows.groupBy("doc_id", "k", "n").agg(F.count("*").alias("copies"))
    line = scratch.save(each.repartitionByRange(parts, "doc_id", "k").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy("doc_id", "k")
    # One row for each range: its ends, and those of its neighbours around the circle.
    here = F.struct(F.col("doc_id").isNotNull().alias("s"), "doc_id", "k", "n")
    ends = line.groupBy("part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    circle = Window.orderBy("part")
    whole = circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("first.k").over(circle), F.first("first.k").over(whole)).alias("after_k"),
                       F.coalesce(F.lag("last").over(circle), F.last("last").over(whole)).alias("ahead"))
    stepped = line.select("*", F.lead("k").over(inside).alias("nk"), F.lag("k").over(inside).alias("bk"), F.lag("n").over(inside).alias("bn"))
    return stepped.join(F.broadcast(ends), "part").select(  # one row for each shuffle partition
        "doc_id", "k", "n", "copies", F.coalesce("nk", "after_k").alias("next_k"), F.coalesce("bk", "ahead.k").alias("before_k"),
        F.coalesce("bn", "ahead.n").alias("before_n"))


def fingerprint_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of the texts and of their edited forms, and how like they and the next
    document's are. See the contract's columns."""
    scratch = Scratch(df.sparkSession, "fingerprints")
    rows = df.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    line = scratch.save(followers(rows.select("doc_id", "k", F.char_length("text").cast("bigint").alias("n")), scratch))

    # Ids come from the narrow rows, so that both uses of the texts move the same two columns, once.
    found = rows.select("k", "text").join(line, "k")
    lent = found.select("k", F.col("before_k").alias("to"), F.expr("left(text, int(floor(before_n / 4)))").alias("piece"))
    lent = lent.dropDuplicates(["to"])
    nth = F.row_number().over(Window.partitionBy("k").orderBy("doc_id"))
    pairs = (found.withColumn("nth", nth).join(lent.select(F.col("to").alias("k"), "piece"), "k", "left")
             .withColumn("last", F.col("nth") == F.col("copies"))
             .withColumn("piece", F.when(F.col("last"), F.col("piece")).otherwise(F.expr("left(text, int(floor(n / 4)))"))))
    edited = F.concat(F.expr("left(text, int(n - floor(n / 4)))"), F.coalesce("piece", F.lit("")))
    pairs = pairs.select("doc_id", "k", F.col("n").alias("n_chars"), "text", edited.alias("edited"),
                         F.when(F.col("last"), F.col("next_k")).otherwise(F.col("k")).alias("next_k"))
    pairs = fingerprints(fingerprints(pairs, "text", "fingerprint"), "edited", "edited_fingerprint")
    done = scratch.save(pairs.select("doc_id", "k", "next_k", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint"))
    after = done.select(F.col("k").alias("next_k"), F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["next_k"])
    return done.join(after, "next_k").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op8_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
