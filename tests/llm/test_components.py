"""How many pairs the joins through an index make of near copies that do not link."""
import random

from tidemark.llm import ngram_join
from tidemark.llm.ngram_join import similar_documents

from .test_ngram_join import same


def test_near_copies_under_the_limit_are_told_apart_before_pairs_are_made(spark, monkeypatch):
    rnd, made, verified = random.Random(5), [], ngram_join.verified
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(240):  # two changed words each: nearly all pairs lie between 0.75 and 0.85
        words = list(base)
        for at in rnd.sample(range(4, 146), 2):
            words[at] = f"x{i}.{at}"
        rows.append((i, " ".join(words)))
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate([(i, " ".join(base[k:])) for k in range(8)])]  # a chain of links

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    same(similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), words=4, num=85, den=100), rows, 4, 85, 100)
    assert sum(made) < 0.5 * len(rows) * (len(rows) - 1) / 2 and made[-1] < 0.1 * len(rows) * (len(rows) - 1) / 2, made
