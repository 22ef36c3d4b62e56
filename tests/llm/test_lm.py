"""Scores against an n-gram model written out with dictionaries."""
import math
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.lm import PSEUDO, score_documents

from .conftest import SF


def by_hand(rows, order):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"] for i, (_, t) in enumerate(rows)}
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    c = Counter()
    for i, w in words.items():
        if not held[i]:
            w = ["<s>", *w]
            c.update(tuple(w[a:b]) for b in range(1, len(w) + 1) for a in range(max(0, b - order), b))
    n, v = sum(x for k, x in c.items() if len(k) == 1 and k != ("<s>",)), sum(len(k) == 1 and k != ("<s>",) for k in c)

    def p(context, w):
        if not context:
            return (c[(w,)] + 1) / (n + v + 1)
        if not c[context]:
            return p(context[1:], w)
        return (c[(*context, w)] + PSEUDO * p(context[1:], w)) / (c[context] + PSEUDO)

    out = []
    for i, w in words.items():
        s = ["<s>", *w]
        score = sum(math.log10(p(tuple(s[max(0, k - order + 1) : k]), s[k])) for k in range(1, len(s)))
        base = sum(math.log10(p((), x)) for x in w)
        out.append((rows[i][0], held[i], len(w), sum(c[(x,)] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_matches_the_model_by_hand(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    same(score_documents(docs, order=order).collect(), by_hand([tuple(r) for r in docs.collect()], order))


def test_odd_rows(spark, odd):
    same(score_documents(odd).collect(), by_hand([tuple(r) for r in odd.select("doc_id", "text").collect()], 2))


def test_empty_table(spark, none):
    assert score_documents(none).collect() == []


def test_held_out_texts_score_better_than_single_words(spark):
    got = score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]
