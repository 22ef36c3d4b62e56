"""License scans against a program that holds every block against every template."""
import math
import random
import re

import pytest

from tidemark.llm.licenses import BASE, TEMPLATES, op11_template_containment, scan, words

from .conftest import DOCS, SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(text, templates=TEMPLATES):
    w, out = split(text), []
    for k, (label, notice) in enumerate(templates):
        t = split(notice)
        m, half = len(set(t)), max(8, 2 ** math.ceil(math.log2(len(t))))
        if len(t) <= 4:
            out += [(k, label, i, i + len(t), 1.0) for i in range(len(w) - len(t) + 1) if w[i : i + len(t)] == t]
            continue
        for i in range(0, len(w), half):
            common = len(set(w[i : i + 2 * half]) & set(t))
            if 5 * common >= 4 * m:
                out.append((k, label, i, min(i + 2 * half, len(w)), common / m))
    return len(w), sorted(out)


def check(spark, docs, templates=TEMPLATES):
    rows = docs.select("doc_id", "text").collect()
    got = scan(docs, ["doc_id"], templates=templates).collect()
    key = lambda r: tuple(map(repr, r))
    assert sorted([(r.doc_id, r.n_words, sorted(map(tuple, r.found))) for r in got], key=key) == sorted([(r.doc_id, *by_hand(r.text, templates)) for r in rows], key=key)
    return got


def noisy(rng, share, k):
    """Templates with some words replaced, among other words."""
    out = []
    for _ in range(rng.randint(0, 3)):
        out += [rng.choice(["the", "of", "license", "software", "mit", "x", "general", "public", "cc", "by"]) for _ in range(rng.randint(0, 90))]
        out += [w if rng.random() > share else "zz" for w in words(rng.choice(TEMPLATES)[1])]
    return (rng.choice([" ", "\n", ", "])).join(out)


def test_blocks(spark):
    rng = random.Random(5)
    rows = [(i, noisy(rng, share, i), "en", "s", 1) for i, share in enumerate([0, 0.1, 0.2, 0.25, 0.3] * 30)]
    got = check(spark, spark.createDataFrame(rows, DOCS))
    assert {m.label for r in got for m in r.found} == {label for label, _ in TEMPLATES}
    assert any(0.8 <= m.containment < 1 for r in got for m in r.found)


def test_generated_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, docs)
    for r in op11_template_containment(spark, SF).collect():
        assert (r.labels == "") == (r.score == 0) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert (r.n_base == 0) == (r.first_word is None) == (r.last_word is None)


TEXTS = ["MIT License", "mit\n license", "mit-license MIT_LICENSE", "mitlicense", "MIT licenses", "the mit " + "a " * 13 + "license", "a " * 7 + "mit license b",
         "a " * 15 + "mit license", "mit mit license license", "Apache License, MIT License and the GNU General Public License", "general public", "İmit license",
         "mit license", "Licensed under CC BY-NC 4.0.", "mit license " * 5000, "license mit", "\x00mit\x7flicense", "MÍT license", ""]


def test_phrases(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)], DOCS)
    got = {r.doc_id: r for r in check(spark, docs)}
    assert len(got[14].found) == 5000 and [m.label for m in got[13].found] == ["cc-by-nc"] and not got[15].found


def test_odd_rows(spark, odd, none):
    check(spark, odd)
    assert scan(none, ["doc_id"]).collect() == []
    other = odd.withColumnRenamed("lang", "n_words").withColumnRenamed("source", "found")
    assert scan(other, ["doc_id"]).columns == ["doc_id", "n_words", "found"] and scan(other, ["doc_id"]).count() == 12


@pytest.mark.parametrize("templates", [BASE, [("one", "word")], [("a", "a b c d e"), ("b", "a a a a a a b")]])
def test_other_templates(spark, templates):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", "e", "word", "mit", "license"]) for _ in range(rng.randint(0, 60))), "en", "s", 1) for i in range(60)]
    check(spark, spark.createDataFrame(rows, DOCS), templates)
    with pytest.raises(ValueError):
        scan(spark.createDataFrame(rows, DOCS), ["doc_id"], templates=[("none", "...")])
