"""The piece table against a rearrangement by string slices."""
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.fim import digests, fill_in_middle, names, op12_piece_table, rendered, restored

from .conftest import DOCS, SF

KEEP = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(doc_id, text):
    text, n = text or "", len(text or "")
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc_id, n, form, a, b - a, out)


def check(docs):
    key = lambda r: tuple(map(repr, r))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((*(w := by_hand(*r))[:5], sha(w[5]), sha(r[1] or "")) for r in rows), key=key)
    found = fill_in_middle(docs)
    assert sorted(map(tuple, digests(found, KEEP, "text", "form", "pieces").collect()), key=key) == want
    out = found.select("doc_id", "form", rendered(F.col("text"), F.col("pieces")).alias("o"), "text").collect()
    assert sorted((repr(r.doc_id), r.o) for r in out) == sorted((repr(d), by_hand(d, t)[5]) for d, t in rows)
    assert all(b"".join(restored(r.o.encode(), r.form)).decode() == (r.text or "") for r in out)


def test_generated_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs)
    forms = {r["form"]: r["count"] for r in op12_piece_table(spark, SF).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm", "spm"} and forms["psm"] > forms["spm"]


def test_odd_rows(spark, odd, none):
    check(odd)
    assert fill_in_middle(none).collect() == []
    assert digests(fill_in_middle(none), KEEP, "text", "form", "pieces").collect() == []


SENTINEL_TEXTS = ["<", "<P", "a<P>b", "<M>", "x<S>", "P>", "S>x<", "<<P", "\U0001f642<é>", "<p>", "<P >", "<S" * 40, "é" * 100 + "<M" + "漢" * 3]


@pytest.mark.parametrize("shift", [0, 100, 200])
def test_pieces_of_sentinels(spark, shift):
    check(spark.createDataFrame([(shift + i, t, "en", "s", 1) for i, t in enumerate(SENTINEL_TEXTS * 3)], DOCS))


def test_clashing_names(spark, odd):
    other = odd.withColumnRenamed("lang", "n").withColumnRenamed("source", "Form").withColumn("pieces", F.lit("x"))
    found, name = fill_in_middle(other), names(other)
    assert found.columns[: len(other.columns)] == other.columns and len(set(c.lower() for c in found.columns)) == len(found.columns)
    got = digests(found, ["doc_id", "pieces", name["n"]], "text", name["form"], name["pieces"])
    assert got.count() == 12 and got.where("pieces = 'x'").count() == 12


def test_rates(spark, odd):
    assert {r.form for r in fill_in_middle(odd, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(odd, rate=100, spm=100).collect()} == {"plain", "spm"}
