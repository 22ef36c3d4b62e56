"""Mixing sources by temperature, with DataFrame functions only.

A source with the share p of all tokens gets the weight p**a, normalised. The exponent a is
bisected between 1 (as collected) and 0 (all equal): the largest one whose weights reach the
target entropy, a fraction of the logarithm of the number of sources; if at that exponent a
source would be read more than ``max_epochs`` times, the smallest one that keeps this limit
instead. Each job of the search works out five halvings at once: it sums over the sources for
the 31 inner points of the interval.

The weights are realised as blocks. A block is one whole permutation of a source's documents by
a hash of the document and the block's number. With a budget of B tokens, a source with T
tokens gets w*B/T blocks; the last one is cut: it takes documents in its order while the tokens
before them are under the rest of the source's budget. Without a budget, B is the smallest one
at which every source is read at least once, so that no document is lost. ``position`` in
[0, 1) orders the whole mixture: a row's place in its block, and the block's in its source.

The cut needs running sums over a source, of which one may hold a third of all rows; they are
taken within slices of the hash, on top of the sums of the slices before. The slices' number
follows the number of rows. Everything else is counts by source, and a join of the documents to
one row per source (broadcast below ``FEW_SOURCES`` rows, else shuffled).

Defined results: null sources form one source; a null or empty text has no tokens, sits in
every full block and in a cut one if its place comes before the cut; if no text has tokens, all
weights go by the number of sources and every row comes once; repeated rows are documents of
their own with the same places; empty tables give no rows; extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col, documents, fresh

#: Target entropy as a fraction of the largest, most readings of a source.
ENTROPY, EPOCHS = 0.97, 4.0

#: Sources up to which their table is broadcast; rows of one slice of a running sum.
FEW_SOURCES, SLICE_ROWS = 20_000, 50_000

#: Levels of halving in one job, and jobs.
LEVELS, JOBS = 5, 6


def tokens(text):
    """Number of tokens of a text: its words by white space, found without a regular expression."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(flat, " "), lambda w: w != "")).cast("long")


def exponent(sources: DataFrame, entropy: float = ENTROPY, epochs: float = EPOCHS) -> float:
    """The exponent for a table with one row per source and its ``tokens`` (> 0)."""
    total, count, least, most = sources.agg(
        F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    if not total or count < 2 or least == most:
        return 1.0
    goal, low, high = entropy * math.log(count), 0.0, 1.0

    def met(points: list[float]) -> list[bool]:
        # With weights p**a: entropy = log(z) - sum(a * p**a * log(p)) / z, z = sum(p**a).
        p = F.col("tokens") / F.lit(float(total))
        sums = sources.agg(*[x.alias(f"{n}{i}") for i, a in enumerate(points) for n, x in (
            ("z", F.sum(F.pow(p, F.lit(a)))), ("l", F.sum(F.pow(p, F.lit(a)) * F.log(p) * F.lit(a))))]).first()
        return [math.log(sums[f"z{i}"]) - sums[f"l{i}"] / sums[f"z{i}"] >= goal for i in range(len(points))]

    if met([1.0])[0]:
        high = low = 1.0
    for _ in range(JOBS if low < high else 0):
        n = 1 << LEVELS
        points = [low + (high - low) * k / n for k in range(1, n)]
        reached = sum(met(points))  # entropy falls as the exponent grows
        step = (high - low) / n
        low, high = low + step * reached, low + step * (reached + 1)
    # Readings of the smallest source against those of the largest: (most / least) ** (1 - a).
    limit = 1.0 - math.log(epochs) / math.log(most / least)
    return min(1.0, max(low, limit))


def weighted(sources: DataFrame, a: float, budget: float | None = None) -> DataFrame:
    """Adds ``weight`` and ``epochs`` (readings of the source) to a table of sources."""
    total, z, largest = sources.agg(
        F.sum("tokens"), F.sum(F.pow("tokens", F.lit(a))), F.max(F.pow("tokens", F.lit(1.0 - a)))).first()
    if not total:
        return sources.withColumn("weight", F.lit(1.0)).withColumn("epochs", F.lit(1.0))
    weight = F.pow("tokens", F.lit(a)) / F.lit(z)
    budget = z * largest if budget is None else float(budget)
    return (sources.withColumn("weight", weight)
            .withColumn("epochs", F.when(F.col("tokens") > 0, F.round(weight * budget / F.col("tokens"), 9)).otherwise(1.0)))


def mix(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
        entropy: float = ENTROPY, epochs: float = EPOCHS, budget: float | None = None) -> DataFrame:
    """The rows of ``df``, each as often as the mixture reads it, with ``n_tokens``, ``weight``
    and ``epochs`` of its source, ``block`` and ``position`` (named so, or ``_llm_...`` where
    ``df`` has such a column)."""
    spark = df.sparkSession
    names = ["n_tokens", "weight", "epochs", "block", "position"]
    taken = {c.lower() for c in df.columns}
    out = [n if n not in taken else fresh(df, n)[0] for n in names]
    s, t, h, th, full, slot, before, copies, cut = fresh(
        df, "source", "tokens", "hash", "text", "full", "slot", "before", "copies", "cut")
    scratch = Scratch(spark, "mixing")

    rows = (df.withColumn(s, col(source)).withColumn(t, tokens(col(text)))
            .withColumn(th, F.xxhash64(col(key), col(text))))
    narrow = scratch.save(rows.select(F.col(s).alias("s"), F.col(t).alias("tokens"), F.col(th).alias("th")))
    sources = scratch.save(narrow.groupBy("s").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    live = sources.where("tokens > 0")
    a = exponent(live, entropy, epochs)
    plan = scratch.save(weighted(live, a, budget).unionByName(
        sources.where("tokens = 0").withColumn("weight", F.lit(0.0)).withColumn("epochs", F.lit(1.0))))
    few = plan.count() <= FEW_SOURCES
    small = F.broadcast if few else (lambda x: x)

    # The cut of each source's last block: a slice and a place in it, from running sums by slice.
    def place(row_hash, block):
        return F.xxhash64(row_hash, block).bitwiseAND((1 << 40) - 1)

    slices = F.greatest(F.lit(1), F.ceil(F.col("docs") / SLICE_ROWS)).cast("long")
    last = (narrow.join(small(plan.withColumnRenamed("s", "ps").withColumnRenamed("tokens", "all")),
                        F.col("s").eqNullSafe(F.col("ps")))
            .withColumn("full", F.floor("epochs")).withColumn("h", place(F.col("th"), F.floor("epochs")))
            .withColumn("rest", (F.col("epochs") - F.col("full")) * F.col("all"))
            .where("rest > 0")
            .withColumn("slice", F.floor(F.col("h") * slices / float(1 << 40))))
    by_slice = last.groupBy("s", "slice", "rest").agg(F.sum("tokens").alias("in_slice"))
    over = Window.partitionBy("s").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.withColumn("ahead", F.coalesce(F.sum("in_slice").over(over), F.lit(0)))
    #: One slice of each source holds the cut.
    hit = by_slice.where("ahead < rest and ahead + in_slice >= rest").select(
        F.col("s").alias("hs"), F.col("slice").alias("hslice"), "ahead")
    inside = last.select("s", "slice", "h", "tokens", "rest").join(
        small(hit), F.col("s").eqNullSafe(F.col("hs")) & (F.col("slice") == F.col("hslice")))
    run = Window.partitionBy("s").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)
    cuts = (inside.withColumn("used", F.col("ahead") + F.coalesce(F.sum("tokens").over(run), F.lit(0)))
            .where("used < rest").groupBy("s").agg(F.max("h").alias("cut")))
    plan = scratch.save(plan.join(cuts.withColumnRenamed("s", "cs"), F.col("s").eqNullSafe(F.col("cs")), "left")
                        .select("s", "weight", "epochs", "cut"))

    # Every row, as often as its source's blocks have it.
    joined = rows.join(small(plan.select(F.col("s").alias(slot), F.col("weight").alias(out[1]),
                                         F.col("epochs").alias(out[2]), F.col("cut").alias(cut))),
                       F.col(s).eqNullSafe(F.col(slot)))
    joined = joined.withColumn(full, F.floor(col(out[2])))
    in_cut = F.coalesce(place(F.col(th), F.col(full)) <= F.col(cut), F.lit(False))
    joined = joined.withColumn(copies, F.col(full) + in_cut.cast("long")).where(F.col(copies) > 0)
    joined = joined.withColumn(out[3], F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
    position = (col(out[3]) + place(F.col(th), col(out[3])) / float(1 << 40)) / F.ceil(col(out[2]))
    return joined.select(*[col(c) for c in df.columns], F.col(t).alias(out[0]), col(out[1]), col(out[2]),
                         col(out[3]), position.alias(out[4]))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "n_tokens", "weight", "epochs", "block", "position")
