"""Jaccard join on word shingles with token-combination prefixes; exact up to 64-bit hashes.

A token is the hash of a shingle; a document's set, its distinct tokens; equal sets are joined
at once and stand for one. Two sets link when den * intersection >= num * union, so a set of n
shares at least t = ceil(num * n / den) tokens with each partner. With all sets in one order of
the tokens, the j-th common token of two sets stands among the first n - t + j of either.

1. Filter. In hash order, the first n - t + k tokens of each set (k about 15 % of n) are dealt
   to buckets. A set with a partner has at least k' of these in common with it (k' is the k of
   its smallest possible partner). Sets with fewer tokens that any other set sent are out.
2. Classes. Over the sets left, every token's number of sets is counted. Tokens in one set come
   first in the order, then the others by frequency. Those in up to ``RARE`` sets are rare, the
   others frequent.
3. Prefixes. If the first common token of two sets is rare, it stands in both plain prefixes
   (n - t + 1): rare tokens there are indexed by themselves. Otherwise all common tokens are
   frequent: then the frequent tokens alone, f of them, share t. Their prefix is extended to
   f - t + g + 1, so that two such sets have g + 1 of its tokens in common, and its tokens are
   dealt by hash into g groups: one group holds two common ones. Each pair of tokens of a group
   is indexed as a combination. With g in proportion to the set's size (a power of two, that of
   the smaller set; a set uses the g of every size it may join), a set has combinations in
   proportion to its size, not to the square.
4. Verify. Pairs that cannot link by their sizes, or by how many of their tokens no other set
   has, are left out. All sets of an index entry are first compared to the entry's smallest set only, and
   linked ones become components. Then, for entries whose sets lie in several components, they
   are compared to a drawn set of the entry, a few times over; at last each set is compared to
   the sets of the other components that it was not compared to before.
   So no link between components is lost, and a large group of near copies costs comparisons in
   proportion to its size. Near copies that do not link are mostly told apart by marks, one bit
   of 1,024 for each token: each bit that only one of two sets has is a token that the other
   lacks, so that few pairs are made of sets whose marks differ by too much to link. A comparison
   intersects the two whole sets.

Defined results: a null, empty or blank text has no shingles and is linked with nothing (its
component is its own id); one with fewer words than a shingle is one shingle; a null id takes
the smallest id of its component, else null; repeated rows get equal results; very long texts
are sets like others; an empty table gives no rows; extra columns are not read by the join and
kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, blocks_for, col, documents, fresh, input_bytes
from tidemark.llm.components import linked_components
from tidemark.llm.words import bucket_edges, mixed, pack, pack_sorted, unpack, unpack_sorted, words_of

#: A token in up to so many sets is rare; extension of the filter's prefix; input bytes for each bucket.
RARE, EXTENSION, BUCKET_BYTES = 8, 0.15, 1 << 22

#: Bits of a set's marks as a power of two, as 64-bit words and their columns.
MARK_BITS = 10
MARKS = (1 << MARK_BITS) // 64
WORDS = [f"w{i}" for i in range(MARKS)]

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class Law:
    """The rule of a link: words in a shingle, and the least similarity num / den (over 1/2);
    and the number of sets up to which a token is rare."""

    def __init__(self, words: int = 5, num: int = 80, den: int = 100, rare: int = RARE):
        if not den < 2 * num <= 2 * den or not 1 <= words <= len(_ODD):
            raise ValueError("similarity over 1/2 up to 1, and 1 to 8 words")
        self.words, self.num, self.den, self.rare = words, num, den, rare

    def least(self, n):
        """Tokens that a set of n shares with each partner; also the partner's least size."""
        return -(-self.num * n // self.den)

    def linked(self, common, n, m):
        return self.den * common >= self.num * (n + m - common)

    def sets(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: the first row, all distinct tokens ascending by text, bounds."""
        for row, words, bounds in words_of(column):
            size = np.diff(bounds)
            whole = np.repeat(size < self.words, size)  # of texts with fewer words than a shingle
            text = np.repeat(np.arange(len(size)), size)
            left = np.repeat(bounds[1:], size) - np.arange(len(words))
            at = np.flatnonzero(left >= self.words)
            tokens = np.zeros(len(at), np.uint64)
            for j in range(self.words):
                tokens += words[at + j] * _ODD[j]
            of = text[at]
            if whole.any():
                short = np.flatnonzero((size > 0) & (size < self.words))
                extra = [np.uint64(sum(int(w) * int(_ODD[j]) for j, w in enumerate(words[bounds[i] : bounds[i + 1]])) + int(size[i]) & (1 << 64) - 1) for i in short]
                tokens, of = np.concatenate([tokens, np.array(extra, np.uint64)]), np.concatenate([of, short])
            tokens = mixed(tokens)
            order = np.lexsort((tokens, of))
            tokens, of = tokens[order], of[order]
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
            tokens, of = tokens[new], of[new]
            yield row, tokens, np.searchsorted(of, np.arange(len(size) + 1))


def set_keys(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A key for each set; sets with the same key are taken for equal."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ _ODD[0]), dtype=np.uint64)])
    return mixed(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * _ODD[1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _narrow(batches, law):
    """(doc_id, text hash, text) to (doc_id, text hash, size of the set, its key)."""
    for batch in batches:
        n, keys = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for row, tokens, bounds in law.sets(batch.column(2)):
            n[row : row + len(bounds) - 1] = np.diff(bounds)
            keys[row : row + len(bounds) - 1] = signed(set_keys(tokens, bounds))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(keys, mask=n == 0)],
                                         names=["doc_id", "text", "n", "key"])


def _extension(n):
    return np.maximum(1, (EXTENSION * n).astype(np.int64))


#: Bits of a token and of a set's key that the filter keeps (besides the token's bucket). What
#: they confuse can only keep a set in, except for two partners with equal keys (2**-40).
_TOKEN_CUT, _KEY_CUT = np.uint64(16), np.uint64(24)

_BLOBS = pa.schema([("bucket", pa.int64()), ("x", pa.binary()), ("y", pa.binary())])
BLOBS = "bucket bigint, x binary, y binary"


def _dealt(tokens: np.ndarray, others: list[np.ndarray], buckets: int, packs) -> Iterator[tuple]:
    """Rows (bucket, packed tokens, packed others ...), by ascending token."""
    order = np.argsort(tokens)
    tokens, others = tokens[order], [x[order] for x in others]
    of, edges = bucket_edges(tokens, buckets)
    for b, i, j in zip(of, edges[:-1], edges[1:]):
        yield (int(b), *(p(x[i:j]) for p, x in zip(packs, [tokens, *others])))


def _filter_send(batches, law, buckets):
    for batch in batches:
        tokens, keys, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], set()
        for _, all_tokens, bounds in law.sets(batch.column(0)):
            n = np.diff(bounds)
            key = set_keys(all_tokens, bounds)
            first = np.array([len(seen) < (seen.add(int(k)) or len(seen)) for k in key], bool)  # copies send once
            reach = np.where(first, np.minimum(n, n - law.least(n) + _extension(n)), 0)
            here = np.arange(len(all_tokens)) - np.repeat(bounds[:-1], n) < np.repeat(reach, n)
            tokens.append(all_tokens[here])
            keys.append(np.repeat(key, n)[here])
        rows = list(_dealt(np.concatenate(tokens), [np.concatenate(keys) >> _KEY_CUT], buckets,
                           (lambda x: pack_sorted(x >> _TOKEN_CUT), pack)))
        yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), _BLOBS)] if rows else
                                         [pa.array([], f.type) for f in _BLOBS], schema=_BLOBS)


def _shared(tokens: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, key) pairs once each, those whose token has several keys; and how many."""
    order = np.lexsort((keys, tokens))
    tokens, keys = tokens[order], keys[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])
    tokens, keys, order = tokens[new], keys[new], order[new]
    starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]) != 0)
    count = np.diff(np.append(starts, len(tokens)))
    count = np.repeat(count, count)
    keep = count > 1
    return order[keep], count[keep], keys[keep]


def _filter_count(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    tokens = np.concatenate([unpack_sorted(x) for x in rows["x"]])
    keys = np.concatenate([unpack(x, np.uint64) for x in rows["y"]])
    _, _, keys = _shared(tokens, keys)
    key, count = np.unique(keys << _KEY_CUT, return_counts=True)
    return pd.DataFrame(list(_dealt(key, [count.astype(np.uint32)], buckets, (pack_sorted, pack))), columns=["bucket", "x", "y"])


def _filter_sum(rows: pd.DataFrame) -> pd.DataFrame:
    keys = np.concatenate([unpack_sorted(x) for x in rows["x"]])
    key, inverse = np.unique(keys, return_inverse=True)
    count = np.bincount(inverse, weights=np.concatenate([unpack(x, np.uint32) for x in rows["y"]]))
    return pd.DataFrame({"cut": signed(key >> _KEY_CUT), "shared": count.astype(np.int64)})


def _set_rows(batches, law):
    for batch in batches:
        keys, sizes, sets = [], [], []
        for _, tokens, bounds in law.sets(batch.column(0)):
            keys.append(signed(set_keys(tokens, bounds)))
            sizes.append(np.diff(bounds))
            sets += [tokens[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys or [np.zeros(0, np.int64)])), pa.array(np.concatenate(sizes or [np.zeros(0, np.int64)])),
                                          pa.array(sets, pa.binary())], names=["key", "n", "tokens"])


_CLASSES = pa.schema([("bucket", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])
CLASSES = "bucket bigint, x binary, y binary, z binary"


def _class_send(batches, buckets):
    for batch in batches:
        data = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
        n = np.array([len(x) for x in data], np.int64)
        keys = batch.column(0).to_numpy().view(np.uint64)
        rows = list(_dealt(np.concatenate(data or [np.zeros(0, np.uint64)]), [np.repeat(keys, n), np.repeat(n, n).astype(np.uint32)], buckets, (pack_sorted, pack, pack)))
        yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), _CLASSES)] if rows else
                                         [pa.array([], f.type) for f in _CLASSES], schema=_CLASSES)


def _class_count(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Tokens of several sets, with their number of sets, dealt by set."""
    tokens = np.concatenate([unpack_sorted(x) for x in rows["x"]])
    keys = np.concatenate([unpack(x, np.uint64) for x in rows["y"]])
    sizes = np.concatenate([unpack(x, np.uint32) for x in rows["z"]])
    at, count, _ = _shared(tokens, keys)
    out = np.stack([tokens[at], count.astype(np.uint64) << np.uint64(32) | sizes[at].astype(np.uint64)], 1) if len(at) else np.zeros((0, 2), np.uint64)
    return pd.DataFrame(list(_dealt(keys[at], [out[:, 0].copy(), out[:, 1].copy()], buckets, (pack_sorted, pack, pack))), columns=["bucket", "x", "y", "z"])


def _groups(law: Law, n: int) -> list[int]:
    """The numbers of groups for combinations that a set of n and its partners up to n use."""
    of = lambda s: 1 << max(0, int((1 - law.num / law.den) * s).bit_length() - 1)
    return sorted({of(law.least(n)), of(n)} | {1 << k for k in range(64) if of(law.least(n)) < 1 << k < of(n)})


def entries(law: Law, n: int, tokens: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Index entries of a set of ``n`` tokens, of which ``tokens`` are in ``count`` (> 1) sets."""
    t, alone = law.least(n), n - len(tokens)
    reach = n - t + 1 - alone  # of the plain prefix, behind the tokens that are in no other set
    if reach <= 0:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, count))
    tokens, rare = tokens[order], count[order] <= law.rare
    out = [mixed(tokens[:reach][rare[:reach]])]
    frequent = tokens[~rare]
    if len(frequent) >= t:
        for g in _groups(law, n):
            ahead = frequent[: len(frequent) - t + g + 1]
            group = ((mixed(ahead ^ _ODD[2]) >> np.uint64(32)) * np.uint64(g)) >> np.uint64(32)
            by = np.lexsort((ahead, group))
            ahead, group = ahead[by], group[by]
            step = 1
            while step < len(ahead):  # neighbours in a group, then those two apart, ...
                same = group[step:] == group[:-step]
                if not same.any():
                    break
                out.append(mixed(mixed(ahead[:-step][same] + np.uint64(g)) + ahead[step:][same]))
                step += 1
    return np.unique(np.concatenate(out))


def _index(rows: pd.DataFrame, law: Law) -> pd.DataFrame:
    keys = np.concatenate([unpack_sorted(x) for x in rows["x"]])
    tokens = np.concatenate([unpack(x, np.uint64) for x in rows["y"]])
    both = np.concatenate([unpack(x, np.uint64) for x in rows["z"]])
    order = np.argsort(keys, kind="stable")
    keys, tokens, both = keys[order], tokens[order], both[order]
    edges = np.append(np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0), len(keys))
    entry, key, size, several = [], [], [], []
    for i, j in zip(edges[:-1], edges[1:]):
        n = int(both[i] & np.uint64(0xFFFFFFFF))
        found = entries(law, n, tokens[i:j], (both[i:j] >> np.uint64(32)).astype(np.int64))
        entry.append(found)
        key.append(np.full(len(found), keys[i]))
        size.append(np.full(len(found), n))
        several.append(np.full(len(found), j - i))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return pd.DataFrame({"entry": signed(join(entry, np.uint64)), "key": signed(join(key, np.uint64)), "n": join(size, np.int64), "several": join(several, np.int64)})


def _mark(batches):
    """(key, size, tokens) to (key, size, ``MARKS`` words of bits)."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, 64 * MARKS), bool)
        for row, x in zip(bits, batch.column(2)):
            row[mixed(np.frombuffer(x.as_buffer(), np.uint64) ^ _ODD[4]) >> np.uint64(64 - MARK_BITS)] = True
        words = np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(batch.num_rows, MARKS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(words[:, i].copy()) for i in range(MARKS)]],
                                         names=["key", "n", *WORDS])


def lacking(low: str, high: str, one: str = "", other: str = "_2") -> str:
    """SQL: at least so many tokens of the one set are not in the other."""
    return " + ".join(f"bit_count({low}{w}{one} & ~{high}{w}{other})" for w in WORDS)


def _verify(batches, law):
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            keep.append(law.linked(int((both[1:] == both[:-1]).sum()), len(x), len(y)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame, marked: DataFrame, law: Law) -> DataFrame:
    """The pairs (a, b) of set keys that link. Those whose marks rule it out are left out first."""
    other = marked.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_2") for c in ("n", *WORDS)])
    pairs = pairs.join(marked.withColumnRenamed("key", "a"), "a").join(other, "b")
    common = F.least(F.col("n") - F.expr(lacking("", "")), F.col("n_2") - F.expr(lacking("", "", "_2", "")))
    pairs = pairs.where(law.linked(common, F.col("n"), F.col("n_2"))).select("a", "b")
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
    return (left.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(lambda rows: _verify(rows, law), "a bigint, b bigint"))


def similar_sets(texts: DataFrame, narrow: DataFrame, law: Law, buckets: int, scratch: Scratch) -> DataFrame:
    """(node, component) over set keys, for sets linked with another one. ``texts``: columns
    (text hash, text); ``narrow``: what ``_narrow`` returns."""
    sent = texts.select("text").mapInArrow(lambda rows: _filter_send(rows, law, buckets), BLOBS)
    counted = sent.groupBy("bucket").applyInPandas(lambda rows: _filter_count(rows, buckets), BLOBS)
    shared = counted.groupBy("bucket").applyInPandas(_filter_sum, "cut bigint, shared bigint")

    one = narrow.where("n > 0").groupBy("key", "n").agg(F.min("text").alias("hash"))
    cut = F.shiftrightunsigned("key", int(_KEY_CUT))
    fewest = F.ceil(F.col("n") * law.num / law.den)
    left = (one.withColumn("cut", cut).join(shared, "cut")
            .where(F.col("shared") >= F.greatest(F.lit(1), F.floor(fewest * F.lit(EXTENSION)))).select("hash"))
    sets = scratch.save(texts.join(left, "hash", "left_semi").dropDuplicates(["hash"]).select("text")
                        .mapInArrow(lambda rows: _set_rows(rows, law), "key bigint, n bigint, tokens binary"))

    index = scratch.save(
        sets.mapInArrow(lambda rows: _class_send(rows, buckets), CLASSES)
        .groupBy("bucket").applyInPandas(lambda rows: _class_count(rows, buckets), CLASSES)
        .groupBy("bucket").applyInPandas(lambda rows: _index(rows, law), "entry bigint, key bigint, n bigint, several bigint"))

    marked = scratch.save(sets.mapInArrow(_mark, "key bigint, n bigint, " + ", ".join(f"{w} bigint" for w in WORDS)))
    # Two sets have at most as many tokens in common as either has that are in several sets, or
    # as it has less those that the other one lacks.
    fits = lambda common: f"{law.den + law.num} * {common} >= {law.num} * (n + n_2)"
    near = lambda low, high: fits(f"least(several, several_2, most - ({lacking(low, high)}), most_2 - ({lacking(low, high, '_2', '')}))")
    return linked_components(index.withColumn("most", F.col("n")), lambda pairs: verified(pairs, sets, marked, law), scratch,
                             fits("least(several, several_2)"), {"n": "min", "most": "max", "several": "max"}, marked.select("key", *WORDS), near)


def similar_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, num: int = 80,
                      den: int = 100, rare: int = RARE) -> DataFrame:
    """Rows (doc_id, hash of the text, n_shingles, component_id, group) for every row of ``df``;
    ``group`` is one value for each class of linked documents, null where there are no words."""
    law, scratch = Law(words, num, den, rare), Scratch(df.sparkSession, "ngrams")
    buckets = blocks_for(input_bytes(df), BUCKET_BYTES, 8)
    texts = df.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("hash"), F.coalesce(col(text), F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    narrow = scratch.save(texts.mapInArrow(lambda rows: _narrow(rows, law), f"doc_id {kind}, text bigint, n bigint, key bigint"))
    parts = scratch.save(similar_sets(texts.select("hash", "text"), narrow, law, buckets, scratch))
    joined = scratch.save(narrow.join(parts.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", F.col("text").alias("hash"), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("group")))
    named = joined.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return (joined.join(named, "group", "left")
            .select("doc_id", "hash", "n_shingles", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "group"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``df`` without near copies: of each class of linked documents the one with the
    smallest id stays (nulls last; of equal ids the one with the smallest text hash; of equal
    rows one). Documents without words stay, each."""
    found = similar_documents(df, doc_id, text, words, num, den)
    first = found.where("group is not null").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")).alias("f")).select("f.doc_id", "f.hash", F.lit(True).alias("stays"))
    empty = found.where("group is null").select("doc_id", "hash", F.lit(False).alias("stays")).distinct()
    k, h, i, stays = fresh(df, "id", "hash", "of", "stays")
    kept = first.union(empty).select(F.col("doc_id").alias(i), F.col("hash").alias(k), F.col("stays").alias(stays))
    rows = df.withColumn(h, F.xxhash64(col(text))).join(kept, (F.col(h) == F.col(k)) & col(doc_id).eqNullSafe(F.col(i)))
    once = rows.where(F.col(stays)).dropDuplicates([doc_id, h])
    return once.select(*map(col, df.columns)).union(rows.where(~F.col(stays)).select(*map(col, df.columns)))


def op3_combination_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir), words=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")
