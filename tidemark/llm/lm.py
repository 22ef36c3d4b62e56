"""Language-model scoring with a weighted backoff automaton whose arcs are spread over the cluster.

The model is an n-gram model with Dirichlet smoothing: with a context h and its shortened form
h', p(w|h) = (c(hw) + m * p(w|h')) / (c(h) + m); at the bottom, p(w) = (c(w) + 1) / (N + V + 1).
As an automaton: a state is a context that occurs in training. A state has an arc for each token
that followed it, weighted log10 p(w|h), to the longest state that the token's history then
ends in; and one failure arc, weighted log10(m / (c(h) + m)), to the state of h'. A text is
walked from its start state to its end token: where a state has no arc for the next token, its
failure arc is taken until one has (the bottom state has an arc for everything), weights add up.

No task holds the whole model. Texts are read once into blocks of bounded size (token numbers
and the block's own word list), which are written out. Each block sends its distinct n-grams
with their training counts to buckets by hash; a bucket adds up what all blocks sent and answers
every block with the totals of what it asked for. A block and its answers make the part of the
automaton that its texts can touch. As a state depends on the last tokens only, the walk takes
all positions of a block in step: the state before each position, then arcs, then failure arcs
where there were none. Counts cover all training documents; nothing is pruned. What is shuffled:
each block's distinct n-grams and their totals.

Tokens: words (``words``), then one end token for each text. Training texts: those whose
crc32(doc_id as text) mod 7 is not 2.

Defined results: a null or empty text is the end token alone; a null id counts as training and
stays null; very long texts are blocks by themselves; repeated rows are texts of their own;
without training texts every token has the probability 1 / 1; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, blocks_for, documents, input_bytes
from tidemark.llm.words import (bucket_edges, mixed, pack, pack_sorted, sliced, texts_of, unpack,
                                unpack_sorted, words_of)

#: Longest n-gram; pseudo-count of the smoothing; bytes of text in a block; input bytes for each bucket.
ORDER, PSEUDO, BLOCK_BYTES, BUCKET_BYTES = 2, 4.0, 1 << 23, 1 << 22

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

BLOCKS = "block bigint, ids array<bigint>, held array<boolean>, lengths binary, tokens binary, words binary"
ASKED = "bucket bigint, level int, block bigint, keys binary, counts binary"
ANSWERS = "bucket bigint, level int, block bigint, totals binary, n_distinct bigint, n_total bigint"
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text) to rows of BLOCKS."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        _, at = texts_of(batch.column(2))
        for i, j in sliced(at, BLOCK_BYTES):
            parts, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, words, bounds in words_of(batch.column(2).slice(i, j - i)):
                parts.append(words)
                lengths.append(np.diff(bounds))
            words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
            row = [[number], [batch.column(0).slice(i, j - i).to_pylist()], [batch.column(1).slice(i, j - i).to_pylist()],
                   [pack(np.concatenate(lengths))], [pack(tokens.astype(np.uint32))], [pack_sorted(words)]]
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()),
                                                     pa.binary(), pa.binary(), pa.binary()))],
                names=["block", "ids", "held", "lengths", "tokens", "words"])


def grams(lengths: np.ndarray, tokens: np.ndarray, words: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For every position of a block, start tokens included: the key of the n-gram that ends
    there, by n; whether it has one (n = 1: false at starts); and the number of its text. A
    position whose n-gram would reach before its text's start has the key of the longest that
    does not."""
    size = lengths + 2
    first = np.cumsum(size) - size
    keys = np.empty(int(size.sum()), np.uint64)
    text = np.repeat(np.arange(len(size)), size)
    inside = np.ones(len(keys), bool)
    inside[first] = False
    inside[first + size - 1] = False
    keys[inside] = words[tokens]
    keys[first], keys[first + size - 1] = START, END
    deep = np.arange(len(keys)) - first[text]  # tokens before this one in its text
    levels = [keys]
    for n in range(2, order + 1):
        longer = levels[-1].copy()
        at = np.flatnonzero(deep >= n - 1)
        # The n-gram is its first n - 1 tokens, then its last one.
        longer[at] = mixed(mixed(levels[-1][at - 1] + np.uint64(n)) + keys[at])
        levels.append(longer)
    return levels, deep, text


def ask(blocks: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of BLOCKS to rows of ASKED: distinct n-grams with the block's training counts."""
    for batch in blocks:
        for row in batch.to_pylist():
            out: dict[str, list] = {"bucket": [], "level": [], "block": [], "keys": [], "counts": []}
            levels, deep, text = grams(*parts_of(row), order)
            learns = ~np.array(row["held"], bool)[text]
            for n, keys in enumerate(levels, 1):
                has = deep >= (1 if n == 1 else n - 1)
                key, inverse = np.unique(keys[has], return_inverse=True)
                count = np.bincount(inverse, weights=learns[has], minlength=len(key)).astype(np.uint64)
                of, edges = bucket_edges(key, buckets)
                for b, i, j in zip(of, edges[:-1], edges[1:]):
                    for name, x in zip(out, (int(b), n, row["block"], pack_sorted(key[i:j]), pack(count[i:j]))):
                        out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("bucket", pa.int64()), ("level", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))


def parts_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unpack(row["lengths"], np.int64), unpack(row["tokens"], np.uint32), unpack_sorted(row["words"])


def answer(asked: pd.DataFrame) -> pd.DataFrame:
    """One bucket's rows of ASKED to rows of ANSWERS; the sums stand in the first row."""
    keys = [unpack_sorted(x) for x in asked["keys"]]
    known, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpack(x, np.uint64) for x in asked["counts"]])
    order = np.argsort(inverse, kind="stable")
    edges = np.searchsorted(inverse[order], np.arange(len(known)))
    totals = np.add.reduceat(counts[order], edges)
    given = np.split(totals[inverse], np.cumsum([len(k) for k in keys])[:-1])
    first = np.arange(len(asked)) == 0
    return pd.DataFrame({
        "bucket": asked["bucket"], "level": asked["level"], "block": asked["block"], "totals": [pack(x) for x in given],
        "n_distinct": np.where(first, (totals > 0).sum(), 0), "n_total": np.where(first, totals.sum(), 0).astype(np.int64)})


class Automaton:
    """The part of the model that one block's n-grams reach. ``levels``: for n = 1, 2, ..., the
    block's distinct n-gram keys, ascending, and their training counts."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], n_total: int, n_distinct: int, starts: int, pseudo: float):
        self.levels, self.pseudo, self.starts = levels, pseudo, starts
        self.bottom = np.log10((levels[0][1] + 1.0) / (n_total + n_distinct + 1.0)) if len(levels[0][0]) else np.zeros(0)

    def walk(self, keys: list[np.ndarray], deep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every token after a start: its log10 probability, that at the bottom state, and
        its training count."""
        at = np.flatnonzero(deep >= 1)
        places = [np.searchsorted(known, k) for (known, _), k in zip(self.levels, keys)]
        counts = [np.append(count, 0)[np.minimum(p, len(count))].astype(np.int64) for (_, count), p in zip(self.levels, places)]
        counts[0][deep == 0] = self.starts
        base = self.bottom[np.minimum(places[0][at], len(self.bottom) - 1)]
        # Weights of the arcs, from the bottom up: log10 p(w | the last k tokens).
        arcs, passes = [base], [np.zeros(len(at))]
        for k in range(1, len(keys)):
            context = counts[k - 1][at - 1].astype(float)
            known = (context > 0) & (deep[at] >= k)
            lower = np.power(10.0, arcs[-1])
            weight = np.log10((counts[k][at] + self.pseudo * lower) / (context + self.pseudo))
            arcs.append(np.where(known, weight, arcs[-1]))
            passes.append(np.where(known, np.log10(self.pseudo / (context + self.pseudo)), 0.0))
        # The state before each token is its longest context that occurs in training.
        state = np.zeros(len(at), np.int64)
        for k in range(1, len(keys)):
            state[(deep[at] >= k) & (counts[k - 1][at - 1] > 0)] = k
        score, walking = np.zeros(len(at)), np.ones(len(at), bool)
        for k in range(len(keys) - 1, -1, -1):
            here = walking & (state == k)
            has_arc = here & ((counts[k][at] > 0) if k else True)
            score[has_arc] += arcs[k][has_arc]
            walking &= ~has_arc
            fails = here & ~has_arc
            score[fails] += passes[k][fails]
            state[fails] = k - 1
        return score, base, counts[0][at]


def score_block(block: pd.DataFrame, answers: pd.DataFrame, order: int, pseudo: float, n_total: int, n_distinct: int) -> pd.DataFrame:
    """One row of BLOCKS and its ANSWERS to rows of SCORES."""
    row = block.iloc[0]
    lengths, tokens, words = parts_of(row)
    keys, deep, text = grams(lengths, tokens, words, order)
    levels = []
    for n in range(1, order + 1):
        mine = answers[answers["level"] == n].sort_values("bucket")
        known = np.unique(keys[n - 1][deep >= (1 if n == 1 else n - 1)])
        levels.append((known, np.concatenate([unpack(x, np.uint64) for x in mine["totals"]] or [np.zeros(0, np.uint64)])))
    end = np.searchsorted(levels[0][0], END)
    model = Automaton(levels, n_total, n_distinct, int(levels[0][1][end]), pseudo)
    score, base, count = model.walk(keys, deep)
    text = text[deep >= 1]
    add = lambda x: np.bincount(text, weights=x, minlength=len(lengths))
    return pd.DataFrame({
        "doc_id": pd.array(list(row["ids"]), "Int64"), "held_out": np.array(row["held"], bool), "n_tokens": lengths + 1,
        "n_known": add(count > 0).astype(np.int64), "base_score": add(base), "score": add(score)})


def score_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, pseudo: float = PSEUDO) -> DataFrame:
    """Trains on the texts that are not held out and scores all; see the contract's columns."""
    scratch = Scratch(df.sparkSession, "lm")
    buckets = blocks_for(input_bytes(df), BUCKET_BYTES, 8)
    held = F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    blocks = scratch.save(df.select(F.col(doc_id).cast("bigint").alias("doc_id"), held.alias("held"),
                                    F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(to_blocks, BLOCKS))
    asked = (blocks.select("block", "held", "lengths", "tokens", "words")
             .mapInArrow(lambda rows: ask(rows, order, buckets), ASKED))
    answers = scratch.save(asked.groupBy("bucket", "level").applyInPandas(answer, ANSWERS))
    n_total, n_distinct = answers.where("level = 1").agg(
        F.coalesce(F.sum("n_total"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0))).first()

    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return score_block(a, b, order, pseudo, n_total, n_distinct)

    scores = blocks.groupBy("block").cogroup(answers.select("block", "bucket", "level", "totals").groupBy("block")).applyInPandas(score, SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_total).cast("long").alias("train_tokens"), "base_score", "score")


def op2_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
