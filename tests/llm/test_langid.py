"""Held-out accuracy, and the fusion of evidence against its formulas written with numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.langid import DECLARED, PRIOR, RIGHT, fit, identify, page_evidence, text_evidence

from .conftest import DOCS

MID = "/root/testdata/sf0.01"


def test_accuracy_on_rows_that_were_not_fitted_on(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    seen = docs.withColumn("label", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    got = identify(seen, declared=None, host="source", label="label").where("doc_id % 3 = 0 and length(text) > 30")
    right, n = got.agg(F.avg((F.col("text_language") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 250 and right > 0.97


def test_declarations_decide_short_texts_and_clean_rows_are_kept(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    got = identify(docs)
    assert got.count() == docs.count() and got.where("not accepted").count() == 0
    assert got.where("language = lang").count() > 0.99 * docs.count()


def test_pages_by_markup_and_suffix(spark):
    rows = [(1, "https://www.a.example.fr/x", "<HTML class=x lang='fr-CA'><script>var en</script><p>le <b>chat</b></p><!-- the -->"),
            (2, "HTTP://u@Host.DE:80/", "<p>der Hund"), (3, None, None), (4, "mailto:x", "")]
    got = {r.page_id: r for r in page_evidence(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1].declared == "fr-CA" and got[1].host == "www.a.example.fr" and got[1].text.split() == ["le", "chat"]
    assert got[2].host == "host.de" and got[2].declared is None and got[3].host is None and got[4].host is None


def test_fusion_by_hand(spark):
    en, fr = "the dog and the cat went out to the wood ", "le chien et le chat dans les bois avec nous "
    rows = [(i, (en if i % 3 else fr) * (i % 4 + 1), "en" if i % 3 else "fr", f"h{i % 5}.{'a' if i % 5 < 3 else 'b'}.{'fr' if i % 2 else 'com'}", 1) for i in range(60)]
    rows += [(100, "le the", "fr", "h1.a.fr", 1), (101, "cat", None, None, 1), (102, "$$ 12", "en", "h1.a.fr", 1), (103, None, "xx", "nodots", 1)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in identify(df).collect()}
    classes, table = fit(df, "text", "lang")
    ll = {r.doc_id: r.ll for r in text_evidence(df, "text", classes, table, "ll").collect()}
    soft = lambda x: np.exp(np.array(x) - np.max(x)) / np.exp(np.array(x) - np.max(x)).sum()
    p = {i: soft(x) for i, x in ll.items() if x is not None}
    n, host, lang = len(classes), {r[0]: r[3] for r in rows}, {r[0]: r[2] for r in rows}
    total = lambda keep: (sum(1 for i in p if keep(i)), sum([p[i] for i in p if keep(i)], np.zeros(n)))
    rows_all, sums_all = total(lambda i: True)
    corpus = (sums_all + 1) / (rows_all + n)
    kinds = max(2, len({lang[i] for i in p if lang[i]}))
    for i in p:
        prior = corpus
        if host[i]:
            above = corpus
            for parts in (1, 2):
                key = ".".join(host[i].split(".")[-parts:])
                m, s = total(lambda j: host[j] and "." in host[j] and ".".join(host[j].split(".")[-parts:]) == key)
                above = (s + PRIOR * above) / (m + PRIOR)
            m, s = total(lambda j: host[j] == host[i])
            prior = (s - p[i] + PRIOR * above) / (m - 1 + PRIOR)
        chance = np.ones(n)
        if lang[i]:
            expect = np.array([1 / kinds if c == "und" else RIGHT if c == lang[i] else (1 - RIGHT) / (kinds - 1) for c in classes])
            hits, totals = total(lambda j: lang[j] == lang[i])[1], total(lambda j: lang[j] is not None)[1]
            chance = np.maximum(1e-9, hits + DECLARED * expect - p[i]) / (totals + DECLARED - p[i])
        want = soft(np.array(ll[i]) + np.log(prior) + np.log(chance))
        assert got[i].language == classes[int(want.argmax())] and got[i].probability == pytest.approx(want.max(), abs=1e-6)
    for i in (102, 103):
        assert (got[i].language, got[i].probability, got[i].accepted) == ("und", 0.0, False)
    assert got[100].accepted and got[101].accepted


def test_odd_rows(spark, odd, none):
    got = identify(odd)
    assert got.columns == [*odd.columns, "language", "probability", "text_language", "accepted"]
    assert {r.accepted for r in got.where("doc_id in (2, 3, 7)").collect()} == {False} and got.count() == 12
    clash = odd.withColumnRenamed("n_chars", "language")
    assert identify(clash).columns[:5] == clash.columns
    assert identify(none).collect() == []
    assert {r.language for r in identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {langid.NONE}


def test_every_language_is_a_class_and_regions_share_one(spark):
    """Eighty languages of twelve rows each, with words of their own, every third row with a region."""
    rng = np.random.default_rng(5)
    names = [f"{a}{b}" for a in "abcdefgh" for b in "pqrstuvwxy"]
    words = {x: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for x in names}
    rows = [(k * 100 + i, " ".join(rng.choice(words[x], 20)), (x, f"{x}-US", f"{x.upper()}_gb")[i % 3], "h", 1) for k, x in enumerate(names) for i in range(12)]
    df = spark.createDataFrame(rows, DOCS)
    classes, table = fit(df, "text", "lang")
    assert classes == [*sorted(names), langid.NONE]
    got = identify(df).collect()
    assert len(got) == len(rows) and all(r.accepted and r.language == r.text_language == r.lang[:2].lower() for r in got)


def test_only_seen_slots_are_stored_beyond_a_bound(spark, monkeypatch):
    rng = np.random.default_rng(6)
    seen = np.unique(rng.integers(0, 70 * langid.SLOTS, 20000))
    of, slot, n = seen // langid.SLOTS, seen % langid.SLOTS, rng.integers(1, 50, len(seen))
    full = langid.table_of(slot, of, n, 71)
    monkeypatch.setattr(langid, "DENSE", 0)
    monkeypatch.setattr(langid, "AT_ONCE", 71 * 7)
    few = langid.table_of(slot, of, n, 71)
    assert isinstance(full, np.ndarray) and sum(x.nbytes for x in few) < full.nbytes / 10
    slots, bounds = rng.choice(slot, 500).astype(np.uint32), np.array([0, 1, 40, 41, 300, 500])
    assert np.allclose(langid.text_sums(slots, bounds, full, 71), langid.text_sums(slots, bounds, few, 71), atol=1e-3)
