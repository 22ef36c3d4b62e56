"""Components against all pairs compared by hand."""
import random
import re

import pytest

from tidemark.llm import ngram_join
from tidemark.llm.ngram_join import Law, one_of_each, similar_documents

from .conftest import DOCS, SF


def sets_by_hand(rows, k):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def by_hand(rows, k, num, den):
    sets = sets_by_hand(rows, k)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def same(found, rows, k, num, den):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=key)
    assert got == sorted(by_hand(rows, k, num, den), key=key)


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_generated_documents(spark, k, num, den):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    same(similar_documents(docs, words=k, num=num, den=den), [tuple(r) for r in docs.collect()], k, num, den)


def chains(seed, n=150):
    """Copies of a few texts with more and more edits, so that many pairs lie about the limit."""
    rnd = random.Random(seed)
    passage = [f"common{i}" for i in range(30)]
    rows = []
    for b in range(5):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([5, 12, 60, 150]))]
        if b % 2:
            base = passage + base
        words = list(base)
        for c in range(n // 5):
            if rnd.random() < 0.5:
                words = list(base)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 60)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("rare", [1, 2, 16])
def test_chains_of_edits(spark, rare):  # combinations for nearly all tokens, or for few
    rows = chains(rare)
    same(similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), words=4, num=85, den=100, rare=rare), rows, 4, 85, 100)


@pytest.mark.parametrize("rare", [1, 3, 50])
def test_two_linked_sets_share_an_entry(rare):
    """The index's promise, for frequencies as they are: without Spark."""
    import pyarrow as pa
    law, rows = Law(2, 80, 100, rare), chains(7, 100)
    sets = []
    for _, tokens, bounds in law.sets(pa.array([t for _, t in rows])):
        sets += [tokens[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
    count = {}
    unique = {s.tobytes(): s for s in sets}
    for s in unique.values():
        for t in s.tolist():
            count[t] = count.get(t, 0) + 1
    import numpy as np
    index = []
    for s in unique.values():
        c = np.array([count[t] for t in s.tolist()])
        index.append((set(s.tolist()), set(ngram_join.entries(law, len(s), s[c > 1], c[c > 1]).tolist())))
    linked = 0
    for i, (a, x) in enumerate(index):
        for b, y in index[:i]:
            if law.linked(len(a & b), len(a), len(b)):
                linked += 1
                assert x & y
    assert linked > 50


def test_odd_rows(spark, odd):
    same(similar_documents(odd), [(r.doc_id, r.text) for r in odd.collect()], 5, 80, 100)
    kept = sorted(((r.doc_id, r.text) for r in one_of_each(odd).collect()), key=str)
    ids = [d for d, _ in kept]
    assert ids.count(6) == 0 and ids.count(1) == 1 and 2 in ids and 3 in ids and 7 in ids and ids.count(None) == 2
    clash = odd.withColumnRenamed("lang", "group").withColumnRenamed("source", "_llm_hash")
    assert one_of_each(clash).columns == clash.columns and one_of_each(clash).count() == len(kept)


def test_empty_table(spark, none):
    assert similar_documents(none).collect() == [] and one_of_each(none).collect() == []


def test_one_row_of_each_class_stays(spark):
    rows = chains(3)
    want = {c for _, n, c in by_hand(rows, 5, 80, 100)}
    got = one_of_each(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS))
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_hashes_of_slices_and_what_a_worker_keeps():
    """Texts over several slices hash as each by itself; the kept powers are few megabytes."""
    import numpy as np
    import pyarrow as pa
    from tidemark.llm import words
    texts = [" ".join(f"W{i * j}" for i in range(j % 900)) for j in range(900)] + ["", "long " * 200_000, "x"]
    kept = list(words._powers)
    words._powers.clear()
    try:
        got = [w[b[k] : b[k + 1]].tolist() for _, w, b in words.words_of(pa.array(texts[:-2])) for k in range(len(b) - 1)]
        assert sum(x.nbytes for x in words._powers) <= 10_000_000
    finally:
        words._powers[:] = kept
    got += [w[b[k] : b[k + 1]].tolist() for _, w, b in words.words_of(pa.array(texts[-2:])) for k in range(len(b) - 1)]
    assert sum(map(len, texts)) > 2 * words.SLICE_BYTES
    one = {w: int(h[0]) for w in {x for t in texts for x in t.lower().split()} for h in [words.hashed(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0]]}
    assert got == [[one[x] for x in t.lower().split()] for t in texts]
