"""Balance, whole groups and gapless slots; weights, budgets and places."""
import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import exponent, mix, tokens
from tidemark.llm.sharding import FIXED, OVERFULL, shard_records, write_shards

from .conftest import DOCS

MID = "/root/testdata/sf0.01"


def filled(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for held in by.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    return {s: sum(r.size for r in by.get(s, [])) for s in range(shards)}


def test_shards_of_documents(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    rows = shard_records(docs, 24).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    assert all(r.size == len(text[r.doc_id].encode()) + FIXED for r in rows)
    sizes = filled(rows, 24)
    largest = max(r.size for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    at = {}
    for r in rows:
        at.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in at.values())


def test_a_group_is_cut_only_if_it_overfills_a_shard(spark):
    for copies, whole in ((90, True), (400, False)):
        rows = [(i, f"text {i} " + "x" * 90, "en", "s", 1) for i in range(1000)] + [(5000 + i, "the same text " + "y" * 90, "en", "s", 1) for i in range(copies)]
        got = shard_records(spark.createDataFrame(rows, DOCS), 8).collect()
        sizes = filled(got, 8)
        assert max(sizes.values()) <= OVERFULL * sum(sizes.values()) / 8 + 500
        assert (len({r.shard for r in got if r.doc_id >= 5000}) == 1) == whole


def test_shard_odd_rows(spark, odd, none):
    got = shard_records(odd, 3).collect()
    assert len(got) == 12
    filled(got, 3)
    assert shard_records(none, 3).collect() == []
    assert shard_records(odd.withColumnRenamed("lang", "range").withColumnRenamed("source", "size"), 3).count() == 12


def test_write(spark, tmp_path):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    write_shards(docs, str(tmp_path / "out"), 6)
    assert spark.read.parquet(str(tmp_path / "out")).select(docs.columns).exceptAll(docs).isEmpty() and docs.count() == spark.read.parquet(str(tmp_path / "out")).count()


def by_hand(t, entropy, epochs):
    total, goal = sum(t), entropy * math.log(len(t))

    def h(a):
        w = [(x / total) ** a for x in t]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    low, high = (1.0, 1.0) if h(1.0) >= goal else (0.0, 1.0)
    for _ in range(60 if low < high else 0):
        mid = (low + high) / 2
        low, high = (mid, high) if h(mid) >= goal else (low, mid)
    return max(low, 1 - math.log(epochs) / math.log(max(t) / min(t)))


@pytest.mark.parametrize("sizes", [[1000, 50, 40, 30], [10**9, 3, 5], [7, 6, 5], [10, 1]])
def test_exponent_is_bisected(spark, sizes):
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(sizes)], "s string, tokens bigint")
    for entropy, epochs in ((0.97, 4.0), (0.8, 100.0)):
        assert exponent(frame, entropy, epochs) == pytest.approx(min(1.0, by_hand(sizes, entropy, epochs)), abs=1e-7)


def test_mixture(spark):
    rows = [(i, "a b c " * (1 + i % 5), "en", f"s{0 if i < 700 else 1 + i % 3}", 1) for i in range(1000)]
    df = spark.createDataFrame(rows, DOCS)
    got = mix(df).collect()
    held = {s: sum(r.n_tokens for r in got if r.source == s) for s in {r.source for r in got}}
    for s, t in held.items():
        weight = next(r.weight for r in got if r.source == s)
        assert t / sum(held.values()) == pytest.approx(weight, abs=15 * len(held) / sum(held.values()))
        blocks = {}
        for r in got:
            if r.source == s:
                blocks.setdefault(r.block, []).append(r)
        n = sum(1 for r in rows if r[3] == s)
        assert all(len({r.doc_id for r in b}) == len(b) for b in blocks.values())  # a permutation, or the beginning of one
        assert all(len(b) == n for k, b in blocks.items() if k < max(blocks)) and all(0 <= r.position < 1 for b in blocks.values() for r in b)
        last = max(r.position for r in blocks[max(blocks)])
        assert all(r.position <= last for b in blocks.values() for r in b)
    small = mix(df, budget=2000.0).collect()
    assert sum(r.n_tokens for r in small) == pytest.approx(2000, abs=15 * 4)


def test_mix_odd_rows(spark, odd, none):
    got = mix(odd)
    assert got.columns == [*odd.columns, "n_tokens", "weight", "epochs", "block", "position"]
    assert {(r.doc_id, r.text) for r in got.collect()} == {(r.doc_id, r.text) for r in odd.collect()}
    clash = odd.withColumnRenamed("lang", "block").withColumnRenamed("n_chars", "_llm_hash")
    assert mix(clash).columns[:5] == clash.columns
    assert mix(none).collect() == [] and mix(odd.where("text is null")).count() == 2
    words = odd.select(tokens(F.col("text")).alias("n"), "text").collect()
    assert [r.n for r in words] == [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in words]
