"""Secret scans with corpus-wide ownership, with DataFrame functions only.

Each whole text is searched by fixed patterns (base spans), and for opaque strings: runs of 20
or more characters of base64 or names that hold a digit, a small and a large letter. The values
found, as hashes, are counted over the corpus: in how many repositories (different texts) and by
how many owners (sources) each appears. A value that ``OWNERS`` or more owners hold is a copied
example; one that few hold, and that looks live (many different characters, none of the words of
placeholders), is a credential. Opaque strings become spans only as credentials; base spans stay
in any case, and are counted as live or example. The counting aggregates by (value, owner) first,
so that a value in a third of all rows is summed up before it is shuffled.

Positions come from the texts between the matches: they and the matches in turn make up the
text, so that their lengths add up to starts and ends, in code points.

Defined results: a null text counts as empty; null owners are one owner; repeated rows get equal
results; rows with the same id, owner and text are one repository's; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col, documents

# The kinds in their order, and the patterns.
KINDS = ("assign", "access", "hex", "opaque")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "opaque": r"[A-Za-z0-9+/_-]{20,}={0,2}",
}
#: What a text holds, as small letters, if the pattern can match.
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",)}
#: Least characters of an assigned value.
ASSIGNED = 12
#: Owners from which a value is an example; different characters of a live-looking value.
OWNERS, VARIETY = 3, 8
PLACEHOLDERS = "(?i)example|sample|placeholder|changeme|dummy|your|xxxx|0000|1234|abcd"


#: A match: its place, kind and value.
MATCHES = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"

#: Elements of an array that are gone through at once. A running value is worked out for each
#: block, then over the blocks: a fold that appends to one array copies what it has at every step.
BLOCK = 256


def _blocks(items: Column) -> Column:
    """The places (from 1) at which the blocks of an array begin; an empty one has one block."""
    return F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(BLOCK))


def _before(blocks: Column, first: Column, join) -> Column:
    """For each element of an array, what ``join`` makes of ``first`` and all elements before it."""
    start = F.struct(first.alias("now"), F.array().cast("array<int>").alias("out"))
    step = lambda d, x: F.struct(join(d["now"], x).alias("now"), F.concat(d["out"], F.array(d["now"])).alias("out"))
    return F.aggregate(blocks, start, step, lambda d: d["out"])


def gaps(text: Column, kind: str) -> Column:
    """All matches of a kind in a text, leftmost first, as an array of (g, l, m): length of the
    text between the match before and this one, length of this one, and the match."""
    hints = HINTS.get(kind)
    if hints:
        may = F.lit(False)
        for hint in hints:
            may = may | F.contains(F.lower(text), F.lit(hint))
    else:
        may = F.regexp_like(text, F.lit(PATTERNS[kind]))
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    out = F.zip_with(F.slice(between, 1, F.size(found)), found,
                     lambda gap, match: F.struct(F.char_length(gap).alias("g"), F.char_length(match).alias("l"), match.alias("m")))
    return F.when(may, out).otherwise(F.array().cast("array<struct<g:int,l:int,m:string>>"))


def in_blocks(found: Column, kind: str) -> Column:
    """The result of ``gaps`` (a column of its own) by blocks: (at, out), a block's length and its
    matches with places counted from the block's beginning."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(MATCHES).alias("out"))

    def step(done, x):
        s = done["at"] + x["g"]
        value = F.regexp_extract(x["m"], PATTERNS[kind], 2) if kind == "assign" else x["m"]
        one = F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s + x["l"]).alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
        return F.struct((s + x["l"]).alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    return F.transform(_blocks(found), lambda i: F.aggregate(F.slice(found, i, BLOCK), start, step))


def placed(blocks: Column) -> Column:
    """The matches of ``in_blocks`` (a column of its own) with their places in the text."""
    before = _before(blocks, F.lit(0), lambda now, x: now + x["at"])
    at = lambda m, by: F.struct((m["start"] + by).alias("start"), m["rank"].alias("rank"), (m["end"] + by).alias("end"),
                                m["kind"].alias("kind"), m["value"].alias("value"))
    return F.flatten(F.zip_with(blocks, before, lambda x, by: F.transform(x["out"], lambda m: at(m, by))))


def apart(every: Column, ends: Column) -> Column:
    """The opaque matches of a text that touch no base one. ``every``: all matches in order;
    ``ends``: by blocks, where the last base one ends, or 0 (both are columns of their own).
    A match may touch any base one before it, but behind it only the next match can do so,
    since opaque ones do not touch each other."""
    opaque = F.lit(KINDS.index("opaque"))
    start = lambda by: F.struct(by.alias("reach"), F.array().cast(MATCHES).alias("out"))

    def step(done, x):
        m, after = x["m"], x["after"]
        free = (m["start"] >= done["reach"]) & (after.isNull() | (after["rank"] == opaque) | (after["start"] >= m["end"]))
        return (F.when(m["rank"] != opaque, F.struct(F.greatest(done["reach"], m["end"]).alias("reach"), done["out"].alias("out")))
                .when(free, F.struct(done["reach"].alias("reach"), F.concat(done["out"], F.array(m)).alias("out"))).otherwise(done))

    with_next = lambda i: F.transform(F.slice(every, i, BLOCK), lambda m, j: F.struct(m.alias("m"), F.get(every, i + j).alias("after")))
    return F.flatten(F.zip_with(_blocks(every), _before(ends, F.lit(0), F.greatest), lambda i, by: F.aggregate(
        with_next(i), start(by), step, lambda d: d["out"])))


def candidates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """Rows (doc_id, owner, text hash, base, opaque): base and opaque matches by start and kind.
    Each select is a step of its own, as an array that a lambda function reads would otherwise be
    worked out again for each of its elements."""
    rows = df.select(col(doc_id).alias("doc_id"), col(owner).alias("owner"), F.coalesce(col(text), F.lit("")).alias("text"))
    own = ["doc_id", "owner", "hash"]
    rows = rows.select("doc_id", "owner", F.xxhash64("text").alias("hash"), *[gaps(F.col("text"), k).alias(k) for k in KINDS])
    rows = rows.select(*own, *[in_blocks(F.col(k), k).alias(k) for k in KINDS])
    rows = rows.select(*own, *[placed(F.col(k)).alias(k) for k in KINDS])
    live = lambda m: F.regexp_like(m["value"], F.lit("[0-9]")) & F.regexp_like(m["value"], F.lit("[a-z]")) & F.regexp_like(m["value"], F.lit("[A-Z]"))
    base = F.concat(F.filter("assign", lambda m: F.char_length(m["value"]) >= ASSIGNED), F.col("access"), F.col("hex"))
    rows = rows.select(*own, F.sort_array(base).alias("base"), F.filter("opaque", live).alias("opaque"))
    rows = rows.select(*own, "base", "opaque", F.sort_array(F.concat("base", "opaque")).alias("every"))
    last = lambda i: F.array_max(F.transform(F.slice("every", i, BLOCK), lambda m: F.when(m["rank"] == KINDS.index("opaque"), 0).otherwise(m["end"])))
    rows = rows.withColumn("ends", F.transform(_blocks(F.col("every")), lambda i: F.coalesce(last(i), F.lit(0))))
    free = F.when((F.size("opaque") == 0) | (F.size("base") == 0), F.col("opaque")).otherwise(apart(F.col("every"), F.col("ends")))
    return rows.select(*own, "base", free.alias("opaque"))


def looks_live(value: Column) -> Column:
    return (F.size(F.array_distinct(F.split(value, ""))) >= VARIETY) & ~F.regexp_like(value, F.lit(PLACEHOLDERS))


def ownership(found: DataFrame) -> DataFrame:
    """For every value of ``candidates``, as a hash: repositories, owners, and whether many own it."""
    each = found.select("owner", "hash", F.explode(F.concat("base", "opaque")).alias("m")).select(
        F.xxhash64("m.value").alias("secret"), "owner", "hash")
    by_owner = each.distinct().groupBy("secret", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("secret").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """One row for every row of ``df``: counts by kind, the base spans' digest, all spans, and how
    many of these are live and how many examples."""
    found = Scratch(df.sparkSession, "secrets").save(candidates(df, doc_id, text, owner))
    found = found.withColumn("k", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("owner").isNull(), "owner", "hash"))
    each = (found.select("k", F.explode(F.concat("base", "opaque")).alias("m")).distinct()
            .select("k", "m", F.xxhash64("m.value").alias("secret")).join(ownership(found), "secret"))
    few = F.col("owners") < OWNERS
    live = few & looks_live(F.col("m.value"))
    bare = F.struct("m.start", "m.rank", "m.end", "m.kind")
    judged = each.groupBy("k").agg(
        F.sort_array(F.collect_list(F.when((F.col("m.kind") != "opaque") | live, bare))).alias("spans"),
        F.count_if(live).alias("n_live"), F.count_if(~few & (F.col("m.kind") != "opaque")).alias("n_examples"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"))
    count = lambda kind: F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return found.join(judged, "k", "left").select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(spans_text(F.col("spans")), F.lit("")).alias("spans"), zero("n_live"), zero("n_examples"),
        zero("most_owners"), zero("most_repositories"))


def op5_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
