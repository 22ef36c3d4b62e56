"""Importance resampling against a program that counts every text by itself."""
import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.resample import importance, op13_line_resampling, resample, spread

from .conftest import DOCS, SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]], len(w)


def by_hand(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (S + 10000)) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for d, text in rows:
        f, n = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    enough = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(enough[: 25 * len(enough) // 100], 1)}
    return [(*r[:4], rank.get(id(r))) for r in out]


def same(got, want):
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_generated_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = by_hand(rows, target)
    same(op13_line_resampling(spark, SF).collect(), want)
    assert sum(r[4] is not None for r in want) >= 20


LINES = ["ABC\nDEF\n\nGhI", "The cat\nsat on\n\n the mat", "a\n", "\na", "a\nb\nc", " \n . \n", "One line of words, and more words: 1\r\n2\x0b3", "the cat\nsat on", "the cat",
         "İstanbul K KELVIN\nÉTÉ été", "x-y\n--\nz \n\n\n w", "word " * 25 + "\n" + "word " * 25, "漢字\U0001f642 b\n漢字", "a" * 3000 + "\n" + "b" * 3000, "tail \n"]


@pytest.mark.parametrize("times", [1, 3])
def test_lines(spark, times):
    rows = [(i, t) for i, t in enumerate(LINES * times)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    target = spark.createDataFrame([(1, "The cat\nsat"), (2, None), (3, "word word")], "item_id bigint, text string")
    found = spread(importance(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")
    same(found.collect(), by_hand(rows, ["The cat\nsat", None, "word word"]))


def test_odd_rows(spark, odd, none):
    target = spark.createDataFrame([(1, "the cat sat")], "item_id bigint, text string")
    more = odd.union(odd).union(spark.createDataFrame([(i, f"tie {i % 2} " * 30, "en", "a", 1) for i in [20, 20, 20, 21, 22, 23, 24, 25]], DOCS))
    rows = [(r.doc_id, r.text) for r in more.collect()]
    got = spread(importance(more, target)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    same(got, by_hand(rows, ["the cat sat"]))
    assert importance(none, target).collect() == []
    empty = importance(odd, target.limit(0))
    same(spread(empty).select("doc_id", "n_features", "weight", "score", "rank").collect(), by_hand([(r.doc_id, r.text) for r in odd.collect()], []))


def test_rows_drawn(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("lang", "hash").withColumnRenamed("source", "_LLM_id")
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    out = resample(docs, target)
    want = {r.doc_id for r in op13_line_resampling(spark, SF).where("rank is not null").collect()}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want and out.count() == len(want)
    copies = spark.createDataFrame([(5, "w " * 30, "en", "s", i) for i in range(40)] + [(i, "v " * 30, "en", "s", i) for i in range(100, 108)], DOCS)
    assert resample(copies, target).count() == 12
