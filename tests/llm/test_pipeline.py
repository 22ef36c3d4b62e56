"""Each stage on what the one before kept, against the stages by hand."""
import hashlib
import math

import tiktoken
import public_tokenizers as P
import pytest

import corpus_pipeline as cp
from tidemark.llm.bpe import encoder
from tidemark.llm.mixing import ENTROPY, EPOCHS

from .conftest import DOCS, SF
from .test_lines import by_hand as lines_by_hand
from .test_ngram_join import by_hand as classes_by_hand


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    top, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(cp.STAGES):
        out.append([docs, None])
        (after := stage(spark, docs, SF)).write.parquet(f"{top}/{k}")
        assert after.columns == docs.columns or k == len(cp.STAGES) - 1
        docs = spark.read.parquet(f"{top}/{k}")
        out[-1][1] = docs
    return [(a.collect(), b.collect()) for a, b in out]


def test_language_keeps_texts_with_letters(stages):
    before, after = stages[0]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if any(c.isalpha() for c in r.text or ""))


def test_lines(stages):
    before, after = stages[1]
    want = {d: t for d, t in lines_by_hand([(r.doc_id, r.text) for r in before])}
    had = {r.doc_id for r in before if (r.text or "").strip()}
    want = {d: t for d, t in want.items() if d not in had or t.strip()}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after) and len(want) < len(before)


def test_near_copies(stages):
    before, after = stages[2]
    by = classes_by_hand([(r.doc_id, r.text) for r in before], 5, 80, 100)
    assert sorted(r.doc_id for r in after) == sorted(d for d, n, c in by if d == c or not n)


def test_mixing(stages):
    before, after = stages[3]
    words = {r.doc_id: len(r.text.split()) for r in before}
    tokens, mixed = {}, {}
    for r in before:
        tokens[r.source] = tokens.get(r.source, 0) + words[r.doc_id]
    for r in after:
        mixed[r.source] = mixed.get(r.source, 0) + words[r.doc_id]
    assert {r.doc_id for r in after} == set(words)
    entropy = lambda x: -sum(v / sum(x.values()) * math.log(v / sum(x.values())) for v in x.values())
    epochs = {s: mixed[s] / tokens[s] for s in tokens}
    longest = max(words.values()) / min(tokens.values())
    assert entropy(mixed) > min(entropy(tokens), ENTROPY * math.log(len(tokens))) - 0.05 or max(epochs.values()) > EPOCHS - longest - 0.1
    assert min(epochs.values()) >= 1 - 1e-9 and max(epochs.values()) <= EPOCHS + longest + 1e-9


def test_encoding(stages):
    before, after = stages[4]
    by = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder().ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(r.text.encode())) for r in before for ids in [by.encode_ordinary(r.text)])
    assert sorted(map(tuple, after)) == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1]))


def test_lines_are_compared_by_characters(spark):
    """Short lines that differ in a year or in one character have too few words in common."""
    line = "Copyright {} Example Corporation and contributors, all rights reserved worldwide"
    texts = [f"the first text, of {w}\n{x}" for w, x in (("winter", line.format(2019)), ("spring and rain", line.format(2020)), ("autumn leaves on roads", line.format("2O20")))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.lines(spark, docs, SF).collect()}
    want = [texts[0], *[t.split("\n")[0] for t in texts[1:]]]
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}
