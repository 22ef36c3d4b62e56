"""Language identification by fusing evidence with Bayes' rule.

The classes are all languages of the labelled rows (``en`` for the labels en, en-US and EN_gb; no
number of them is set), and ``und``, for which every letter group is as likely as any other.
Evidence on a row:

* its text: letter trigrams (bytes of the small letters within a word, word ends included) under
  one multinomial per language, in logarithms, divided by 3 as each letter is in three trigrams;
* the language that its markup declares: the chance of that declaration under each language;
* its address: the prior of its host, smoothed towards that of its domain, this one towards that
  of its suffix (the last part of the host's name), and this one towards the whole corpus.

The text model is fitted on about ``SAMPLE`` labelled rows for each language, drawn by a hash. Its
table has a row for each slot up to ``DENSE`` bytes, and beyond that only what was seen. All else
comes from all rows: each row's text gives it a probability for every class; sums of these by
declaration, host, domain, suffix and overall, with ``PRIOR`` rows' weight for the level above, are the priors and the chances. A
row's own share is taken out of its host's and declaration's sums before they judge it. Sums are
aggregated in each task before they move, so that one host may hold any share of the rows.

A row is rejected when ``und`` is its likeliest class or its text has no letters.

Defined results: a null or empty text, or one without letters, is ``und``, and rejected; a null
host has the corpus's prior, a null declaration says nothing; very long texts are read whole;
repeated rows get equal results; without labelled rows everything is ``und``; an empty table
gives no rows; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, col, documents, fresh, ship
from tidemark.llm.words import SLICE_BYTES, sliced, texts_of

#: Labelled rows for each language, trigram slots, weight of a level above, its weight for
#: declarations and the chance that a declaration is right, before any evidence.
SAMPLE, SLOTS, PRIOR, DECLARED, RIGHT = 1_000, 1 << 16, 10.0, 20.0, 0.9

#: Bytes up to which the text model is a full table (slot, class); values worked on at once beyond.
DENSE, AT_ONCE = 32 << 20, 4_000_000

#: Hosts up to which their table is broadcast.
FEW_HOSTS = 100_000

NONE = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all trigrams whose middle is a letter, and the texts' bounds among them."""
    low = _LETTER[data].astype(np.uint32)
    before, after = np.roll(low, 1), np.roll(low, -1)
    edge = at[at < len(low)]
    before[edge] = 32
    after[at[at > 0] - 1] = 32
    letter = np.flatnonzero(low != 32)
    slots = ((before << 16 | low << 8 | after)[letter] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return slots, np.searchsorted(letter, at)


def runs(column: pa.Array):
    data, at = texts_of(column)
    for i, j in sliced(at, SLICE_BYTES):
        yield i, *trigrams(data[at[i] : at[j]], at[i : j + 1] - at[i])


def fit(df: DataFrame, text: str, label: str) -> tuple[list[str], np.ndarray | tuple]:
    """Classes, and the log probabilities (slot, class) as ``table_of`` has them; the last class is
    NONE."""
    rows = df.select(primary(col(label).cast("string")).alias("label"), col(text).alias("text")).where("label is not null and text is not null")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    names = sorted(x for x in sizes if x != NONE)
    slot = of = n = np.zeros(0, np.int64)
    if names:
        kinds = df.sparkSession.createDataFrame([(x, i, SAMPLE / sizes[x]) for i, x in enumerate(names)], "label string, of bigint, share double")
        unit = F.xxhash64(F.lit("sample"), "text").bitwiseAND((1 << 52) - 1) / float(1 << 52)

        def count(batches):
            for batch in batches:
                kind = batch.column(0).to_numpy()
                for i, slots, bounds in runs(batch.column(1)):
                    of = np.repeat(kind[i : i + len(bounds) - 1], np.diff(bounds))
                    seen, n = np.unique(of * SLOTS + slots, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"seen": seen, "n": n}, schema=pa.schema([("seen", pa.int64()), ("n", pa.int64())]))

        drawn = rows.join(F.broadcast(kinds), "label").where(unit < F.col("share")).select("of", "text").mapInArrow(count, "seen bigint, n bigint")
        part = drawn.groupBy("seen").agg(F.sum("n").alias("n")).toPandas()
        of, slot, n = part["seen"].to_numpy() // SLOTS, part["seen"].to_numpy() % SLOTS, part["n"].to_numpy()
    return [*names, NONE], table_of(slot, of, n, len(names) + 1)


def table_of(slot: np.ndarray, of: np.ndarray, n: np.ndarray, classes: int) -> np.ndarray | tuple:
    """Log probabilities from the counts that are not zero: a full table (slot, class), or, if this
    were over ``DENSE`` bytes, (bounds of the slots, classes, what is added for them, and each
    class's value for a slot that it has not seen)."""
    smooth = 0.02
    total = np.bincount(of, n, classes) + smooth * SLOTS
    if SLOTS * classes * 4 <= DENSE:
        table = np.tile(np.log(smooth / total).astype(np.float32), (SLOTS, 1))
        table[slot, of] = np.log((n + smooth) / total[of])
        return table
    order = np.lexsort((of, slot))
    at = np.searchsorted(slot[order], np.arange(SLOTS + 1))
    return at, of[order].astype(np.int32), np.log((n + smooth) / smooth)[order].astype(np.float32), np.log(smooth / total)


def text_sums(slots: np.ndarray, bounds: np.ndarray, table: np.ndarray | tuple, classes: int) -> np.ndarray:
    """Sums of the log probabilities (text, class) of texts that each have some slots."""
    if isinstance(table, np.ndarray):
        return np.add.reduceat(table[slots].astype(np.float64), bounds[:-1], axis=0)
    at, of, more, unseen = table
    n = np.diff(bounds)
    sums, text = n[:, None] * unseen, np.repeat(np.arange(len(n)), n)
    step = max(1, AT_ONCE // classes)
    for i in range(0, len(slots), step):
        part, where = slots[i : i + step], text[i : i + step]
        long = at[part + 1] - at[part]
        entry = np.arange(long.sum()) + np.repeat(at[part] - np.cumsum(long) + long, long)
        first, last = where[0], where[-1] + 1
        sums[first:last] += np.bincount((np.repeat(where, long) - first) * classes + of[entry], more[entry], (last - first) * classes).reshape(-1, classes)
    return sums


def text_evidence(df: DataFrame, text: str, classes: list[str], table: np.ndarray | tuple, out: str) -> DataFrame:
    """Adds the text's log likelihood of each class; null where the text has no letters."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def evidence(texts: pa.Array) -> pa.Array:
        scores, has = np.zeros((len(texts), len(classes))), np.zeros(len(texts), bool)
        for i, slots, bounds in runs(texts):
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            if len(some):
                scores[i + some] = text_sums(slots, np.append(bounds[some], bounds[-1]), shared.value, len(classes)) / 3.0
                has[i + some] = True
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(classes)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()), mask=pa.array(~has))

    return df.withColumn(out, evidence(F.coalesce(col(text), F.lit(""))))


def once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, also where ``use`` has it within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normal(logs: Column) -> Column:
    """Log values of classes to probabilities that sum to one."""
    parts = once(logs, lambda v: once(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    return once(parts, lambda v: once(total(v), lambda t: F.transform(v, lambda x: x / t)))


def levels(host: Column) -> tuple[Column, Column]:
    """A host's domain (its last two parts) and suffix (its last one); null without a dot."""
    return (F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -2)),
            F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)))


def primary(declared: Column) -> Column:
    """The language of a declaration such as ``en-US``."""
    return F.nullif(F.lower(F.btrim(F.regexp_substr(declared, F.lit("^[^-_;,]*")))), F.lit(""))


def address_priors(evidence: DataFrame, n: int) -> tuple[DataFrame, list[float]]:
    """Rows (host, rows, sums, above) from rows (host, p): each host's sums of probabilities and
    its domain's smoothed prior; and the corpus's prior."""
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(n)]
    added = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    domain, suffix = levels(F.col("host"))
    hosts = evidence.groupBy("host").agg(F.count("*").alias("rows"), *sums).withColumn("domain", domain).withColumn("suffix", suffix)
    total = hosts.agg(F.sum("rows").alias("rows"), *added).first()
    corpus = [((total[f"s{i}"] or 0.0) + 1.0) / ((total["rows"] or 0) + n) for i in range(n)]
    hosts = hosts.where("host is not null")

    def smoothed(level: str, above: list[Column], frame: DataFrame, name: str) -> DataFrame:
        return frame.select(level, F.array(*[
            (F.col(f"s{i}") + PRIOR * above[i]) / (F.col("rows") + PRIOR) for i in range(n)]).alias(name))

    by_suffix = hosts.where("suffix is not null").groupBy("suffix").agg(F.sum("rows").alias("rows"), *added)
    by_suffix = smoothed("suffix", [F.lit(x) for x in corpus], by_suffix, "suffix_prior")
    by_domain = hosts.where("domain is not null").groupBy("domain", "suffix").agg(F.sum("rows").alias("rows"), *added).join(by_suffix, "suffix")
    by_domain = smoothed("domain", [F.get("suffix_prior", F.lit(i)) for i in range(n)], by_domain, "domain_prior")
    flat = F.array(*[F.lit(x) for x in corpus])
    return hosts.join(by_domain, "domain", "left").select(
        "host", "rows", F.array(*[f"s{i}" for i in range(n)]).alias("sums"), F.coalesce("domain_prior", flat).alias("above")), corpus


def declared_chances(evidence: DataFrame, classes: list[str]) -> DataFrame:
    """Rows (declared, hits, totals): for each declaration and class, the sums of probabilities
    with it, and of all rows that declare something, with the weight of what is expected added."""
    n = len(classes)
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(n)]
    by = evidence.where("declared is not null").groupBy("declared").agg(*sums)
    total = by.agg(F.count("*").alias("kinds"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]).first()
    kinds = max(2, total["kinds"] or 0)

    def expected(i):
        if classes[i] == NONE:
            return F.lit(1.0 / kinds)
        return F.when(F.col("declared") == classes[i], F.lit(RIGHT)).otherwise(F.lit((1 - RIGHT) / (kinds - 1)))

    return by.select("declared", F.array(*[F.col(f"s{i}") + DECLARED * expected(i) for i in range(n)]).alias("hits"),
                     F.array(*[F.lit(float(total[f"s{i}"] or 0.0) + DECLARED) for i in range(n)]).alias("totals"))


def identify(df: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source",
             label: str | None = "lang") -> DataFrame:
    """``df`` with ``language``, ``probability``, ``text_language`` (by the text alone) and
    ``accepted`` (``_llm_...`` where ``df`` has such columns). Labels are read for fitting only."""
    scratch = Scratch(df.sparkSession, "language")
    classes, table = fit(df, text, label)
    n = len(classes)
    taken = {c.lower() for c in df.columns}
    names = [x if x not in taken else fresh(df, x)[0] for x in ("language", "probability", "text_language", "accepted")]
    ll, p, h, d, hd, hh, rows, sums, above, hits, totals, post = fresh(
        df, "ll", "p", "host", "declared", "key_d", "key_h", "rows", "sums", "above", "hits", "totals", "post")

    def scored(frame: DataFrame) -> DataFrame:
        frame = text_evidence(frame, text, classes, table, ll)
        return (frame.withColumn(p, normal(F.col(ll)))
                .withColumn(h, col(host).cast("string") if host else F.lit(None).cast("string"))
                .withColumn(d, primary(col(declared).cast("string")) if declared else F.lit(None).cast("string")))

    evidence = scratch.save(scored(df).where(F.col(p).isNotNull()).select(F.col(h).alias("host"), F.col(d).alias("declared"), F.col(p).alias("p")))
    hosts, corpus = address_priors(evidence, n)
    hosts = scratch.save(hosts.select(F.col("host").alias(hh), F.col("rows").alias(rows), F.col("sums").alias(sums), F.col("above").alias(above)))
    said = scratch.save(declared_chances(evidence, classes).select(F.col("declared").alias(hd), F.col("hits").alias(hits), F.col("totals").alias(totals)))
    small = lambda t: F.broadcast(t) if t.count() <= FEW_HOSTS else t
    out = scored(df).join(small(hosts), F.col(h) == F.col(hh), "left").join(small(said), F.col(d) == F.col(hd), "left")

    tiny, at = F.lit(1e-9), lambda name, i: F.get(F.col(name), i)
    flat = F.array(*[F.lit(x) for x in corpus])
    prior = lambda i: F.coalesce((F.greatest(F.lit(0.0), at(sums, i) - at(p, i)) + PRIOR * at(above, i))
                                 / (F.greatest(F.lit(0), F.col(rows) - 1) + PRIOR), F.get(flat, i))
    chance = lambda i: F.coalesce(F.greatest(tiny, at(hits, i) - at(p, i)) / F.greatest(tiny, at(totals, i) - at(p, i)), F.lit(1.0))
    logs = F.transform(ll, lambda x, i: x + F.log(F.greatest(tiny, prior(i))) + F.log(F.greatest(tiny, chance(i))))
    out = out.withColumn(post, F.when(F.col(ll).isNotNull(), normal(logs)))
    best = lambda x: F.coalesce(F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(x, F.array_max(x)).cast("int")), F.lit(NONE))
    out = (out.withColumn(names[0], best(F.col(post))).withColumn(names[1], F.coalesce(F.array_max(F.col(post)), F.lit(0.0)))
           .withColumn(names[2], best(F.col(p))))
    return out.select(*map(col, df.columns), *[col(x) for x in names[:3]], (col(names[0]) != NONE).alias(names[3]))


def page_evidence(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with the text, the declared language and the host."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.select("page_id", "url", bare.alias("text"),
                        F.nullif(F.regexp_extract("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z0-9_-]+)", 1), F.lit("")).alias("declared"),
                        F.lower(F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))).alias("host"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select("doc_id", F.col("lang").alias("declared"), "language", "probability", "text_language", "accepted")


def language_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over raw pages, with markup, host and suffix; fitted on the pages' declarations."""
    pages = page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return identify(pages, declared="declared", host="host", label="declared").select(
        "page_id", "declared", "host", "language", "probability", "text_language", "accepted")
