"""Connected components by rounds of stars, and links found through an index, with joins and
grouped minima only.

An edge table shrinks towards one star for each component: in the large-star step every node
sends its larger neighbours to the smallest node it knows, in the small-star step its smaller
ones. A node with many neighbours is a key of a grouped minimum and of a join (which Spark can
split), never a group in one task. Each round is written to the shared scratch folder. The
rounds end when no node is both a child and a parent, or a child twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

#: Comparisons to a drawn member, before components are paired; the entries where this begins.
ROUNDS, SHARE = 2, 8


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(down.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) of a comparable type, in any direction, repeated or not, to rows (node,
    component) for every node of an edge; a component is named by its smallest node."""
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now = scratch.save(edges)
    while True:
        seen = now.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
            now.select("b", F.lit(0), F.lit(1)))
        loose = (seen.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
                 .where("c > 1 or (c = 1 and p = 1)"))
        if loose.isEmpty():
            break
        after = scratch.save(_round(now))
        scratch.drop(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", F.col("b")).distinct())


def linked_components(index: DataFrame, verify: Callable[[DataFrame], DataFrame], scratch: Scratch, fits: str | None = None,
                      loosest: dict[str, str] | None = None, marks: DataFrame | None = None, near: Callable[[str, str], str] | None = None) -> DataFrame:
    """Components of the links among the members of an index: rows (entry, key) and maybe more
    columns, to rows (node, component) for the keys that have links.

    ``verify`` keeps the linked ones of pairs (a, b) of keys. All members of an entry are first
    compared to its smallest one. Then, ``ROUNDS`` times, in entries whose members lie in several
    components, those of other components are compared to a member drawn anew for each entry.
    Then, first in every ``SHARE``-th entry and after that in all that are still divided, each
    member is compared to the members of the other components that it was not compared to before:
    no link between components is lost, and pairs inside one are not made. Two members mostly
    share many entries: the first of these two steps joins nearly all that hangs together, from
    few copies of a pair.

    ``fits``: a condition that linked members meet, on their further columns (those of the second
    one have ``_2`` behind their names). ``loosest`` names for each of these columns the end,
    "min" or "max", at which the condition is most easily met; components of an entry that do not
    meet it with these ends are not taken up.

    ``marks``: rows (key, bigint columns) with bits for each key, for a sharper condition:
    ``near(low, high)`` gives it for the bits that all members of a component have (columns named
    ``low`` and the mark's name) and those that any has (``high``), and on the columns of
    ``fits``. It is looked at where two members or components meet, before any pair is made."""
    more, fit = dict(loosest or {}), F.expr(fits or "true")
    bits = [c for c in marks.columns if c != "key"] if marks is not None else []
    closer = lambda low, high: fit & F.expr(near(low, high)) if bits else fit
    renamed = lambda frame: frame.select("entry", *[F.col(c).alias(f"{c}_2") for c in frame.columns if c != "entry"])
    pair = [F.greatest("key", "key_2").alias("a"), F.least("key", "key_2").alias("b")]
    ends = index.groupBy("entry").agg(F.min("key").alias("p"), F.max("key").alias("q")).where("p < q").select("entry", "p")
    index = scratch.save(index.join(ends, "entry"))
    heads = renamed(index.where("key = p").select("entry", *more).dropDuplicates(["entry"]))
    tried = index.where("key <> p")
    if more:
        tried = tried.join(heads, "entry").where(fit)
    tried = scratch.save(tried.select(F.col("key").alias("a"), F.col("p").alias("b")).distinct())
    parts = scratch.save(components(scratch.save(verify(tried)), scratch))

    def divided(frame: DataFrame) -> DataFrame:
        """The members of entries with several components, as these are now."""
        member = frame.select("entry", "key", *more).join(parts.withColumnRenamed("node", "key"), "key", "left").select(
            "entry", "key", *more, F.coalesce("component", "key").alias("c"))
        several = member.groupBy("entry").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("entry")
        return scratch.save(member.join(several, "entry"))

    def drawn(member: DataFrame, turn: int) -> DataFrame:
        """Pairs with a drawn member of the entry."""
        one = member.groupBy("entry").agg(F.min(F.struct(F.xxhash64("entry", "key", F.lit(turn)), "key", "c", *more)).alias("d"))
        one = one.select("entry", *[F.col(f"d.{c}").alias(f"{c}_2") for c in ("key", "c", *more)])
        return member.join(one, "entry").where((F.col("c") != F.col("c_2")) & fit)

    def across(member: DataFrame) -> DataFrame:
        """Pairs of members of different components."""
        if bits:
            member = member.join(marks, "key")
        kinds = member.groupBy("entry", "c").agg(F.count("*").alias("members"), *[F.expr(f"{end}({c})").alias(c) for c, end in more.items()],
                                                 *[F.bit_and(c).alias(f"all_{c}") for c in bits], *[F.bit_or(c).alias(f"any_{c}") for c in bits])
        # The component with fewer members comes first: its members are the rows that meet the other's.
        fewer = F.struct("members", "c") < F.struct("members_2", "c_2")
        met = kinds.join(renamed(kinds), "entry").where(fewer & closer("all_", "any_")).select("entry", "c", "c_2")
        return met.join(member, ["entry", "c"]).join(renamed(member), ["entry", "c_2"]).where(closer("", ""))

    member = divided(index)
    steps = [lambda x, turn=turn: drawn(x, turn) for turn in range(ROUNDS)]
    for step in [*steps, lambda x: across(x.where(F.pmod(F.xxhash64("entry"), F.lit(SHARE)) == 0)), across]:
        pairs = scratch.save(step(member).select(*pair).distinct().join(tried, ["a", "b"], "left_anti"))
        links, tried = scratch.save(verify(pairs)), tried.union(pairs)
        if not links.isEmpty():
            parts = scratch.save(components(parts.where("node <> component").select(
                F.col("node").alias("a"), F.col("component").alias("b")).union(links), scratch))
            before, member = member, divided(member)
            scratch.drop(before)
        if member.isEmpty():
            break
    return parts
