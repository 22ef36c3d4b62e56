"""License scans by an exact set-similarity join of text blocks with license templates.

A template is a license's notice, or a phrase that names one; a block is a window of the words of
a document. A template of up to L words (a power of two, 8 at least) is looked for in the windows
of 2L words that begin at every multiple of L, so that each run of L words lies whole in one. A
block meets a template of m distinct words if it holds at least o = ceil(0.8 m) of them; that is
found for every block, by these steps:

1. Order. How often each word of the templates occurs is summed over all documents; rare words
   come first in the global order. (Other words cannot be shared, and are left out of blocks.)
2. Prefix filter. A block with o words of a template holds one of the m - o + 1 rarest of them:
   only these are in the index (word, template, place in the template), a table whose size is
   that of the templates.
3. Length and position filters. A block with fewer than o words, or where the common word's
   places in block and template leave room for fewer than o common ones, is left out.
4. Verification. The common words of the other pairs are counted.
5. In blocks that meet a phrase (a template of up to ``PHRASE`` words, which needs all of them),
   the places where its words stand one after another are its matches.

The index goes to every task, the documents stay where they are: nothing is shuffled but the
counts of step 1, one row for each word of the templates from each task. Words are compared by
64-bit hashes.

Defined results: a null or empty text has no words and no matches (score 0); ties in frequency
are ordered by the word; repeated rows get equal results; null ids are kept; very long texts are
read whole, each by itself; an empty table gives no rows; extra columns are not read by ``scan``,
which returns the columns asked for and its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, col, documents, ship
from tidemark.llm.words import SLICE_BYTES, hashed, sliced, texts_of

# The phrases of the base and their labels, then the library's own templates.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    *BASE,
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by", "creative commons attribution"),
    ("bsd", "bsd license"),
    ("mpl", "mozilla public license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
            " (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,"
            " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
            " furnished to do so, subject to the following conditions"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
               " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed"
               " under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
            " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This"
            " program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
            " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
            " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the"
            " following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
            " the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
            " provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
            " with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
                  " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose"),
]
#: The least part of a template's words in a block; words of a phrase, and of the least window's half.
CONTAINMENT, PHRASE, LEAST_HALF = Fraction(8, 10), 4, 8

# Bytes to what they count as: letters to small ones, all that is in no word to spaces.
_AS = np.full(256, 32, np.uint8)
_AS[48:58], _AS[97:123], _AS[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_AS[65:91] = np.arange(97, 123)

FOUND = "array<struct<template:int,label:string,start:bigint,end:bigint,containment:double>>"
_FOUND = pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])


def words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Templates:
    """What is fixed before the documents are seen: words, sizes and windows of each template."""

    def __init__(self, templates: list[tuple[str, str]], containment=CONTAINMENT):
        self.labels = [label for label, _ in templates]
        self.words = [words(text) for _, text in templates]
        if not all(self.words):
            raise ValueError("a template without words")
        self.m = np.array([len(set(w)) for w in self.words])
        self.phrase = np.array([len(w) <= PHRASE for w in self.words])
        self.need = np.array([m if p else -int(-containment * int(m) // 1) for m, p in zip(self.m, self.phrase)])
        self.half = np.array([max(LEAST_HALF, 1 << (len(w) - 1).bit_length()) for w in self.words])
        self.vocabulary = sorted({x for w in self.words for x in w})
        keys = np.array([hashed(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0][0] for x in self.vocabulary], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def hits(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the templates' words among the words, and which of the vocabulary each is."""
        at = np.minimum(np.searchsorted(self.keys, tokens), len(self.keys) - 1)
        places = np.flatnonzero(self.keys[at] == tokens)
        return places, self.order[at[places]]


class Index:
    """The prefix index: the templates' words in the global order."""

    def __init__(self, templates: Templates, count: dict[int, int]):
        t = self.templates = templates
        size = len(t.vocabulary)
        by = sorted(range(size), key=lambda v: (count.get(v, 0), t.vocabulary[v]))
        self.rank = np.empty(size, np.int64)
        self.rank[by] = np.arange(size)
        place = {x: int(self.rank[v]) for v, x in enumerate(t.vocabulary)}
        self.member = np.zeros((len(t.words), size), bool)
        self.phrases = np.full((len(t.words), PHRASE), -1)
        entries = []
        for k, w in enumerate(t.words):
            ranks = sorted({place[x] for x in w})
            self.member[k, ranks] = True
            entries += [(r, k, i) for i, r in enumerate(ranks[: len(ranks) - int(t.need[k]) + 1])]
            if t.phrase[k]:
                self.phrases[k, : len(w)] = [place[x] for x in w]
        entries.sort()
        self.word, self.template, self.place = np.array(entries).T
        self.classes = []
        for half in sorted(set(t.half.tolist())):
            mine = np.flatnonzero(t.half == half)
            keep = np.isin(self.template, mine)
            edges = np.searchsorted(self.word[keep], np.arange(size + 1))
            self.classes.append((half, self.member[mine].any(0), edges, self.template[keep], self.place[keep]))


def spans(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start, start + 1, ... of each span, and of which span each is."""
    of = np.repeat(np.arange(len(start)), length)
    return np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + start[of], of


def joined(index: Index, half: int, vocabulary: np.ndarray, edges: np.ndarray, template: np.ndarray, place: np.ndarray,
           at: np.ndarray, rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (block, template) of one window size that meet, and how many words they share.
    ``at``: where words stand; ``rank``: which; ``first``: where their documents begin."""
    t, size = index.templates, len(index.rank)
    mine = vocabulary[rank]
    block, rank, first = at[mine] // half, rank[mine], first[mine] // half
    early = block > first
    key = np.unique(np.concatenate([block * size + rank, (block[early] - 1) * size + rank[early]]))
    block, rank = np.divmod(key, size)  # each block's distinct words in the global order
    begin = np.flatnonzero(np.diff(block, prepend=-1))
    of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(block))))
    many = np.diff(np.append(begin, len(block)))
    j = np.arange(len(block)) - begin[of]

    entry, hit = spans(edges[rank], edges[rank + 1] - edges[rank])
    k, i, j, b = template[entry], place[entry], j[hit], of[hit]
    m, need, n = t.m[k], t.need[k], many[b]
    fits = (n >= need) & (j <= n - need) & (1 + np.minimum(i, j) + np.minimum(m - i, n - j) - 1 >= need)
    b, k = np.divmod(np.unique(b[fits] * len(t.m) + k[fits]), len(t.m))

    word, pair = spans(begin[b], many[b])
    common = np.bincount(pair, weights=index.member[k[pair], rank[word]], minlength=len(b)).astype(np.int64)
    met = common >= t.need[k]
    return block[begin[b[met]]], k[met], common[met]


def places(index: Index, half: int, block: np.ndarray, k: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where, template) for the phrases whose words stand one after another in the blocks."""
    low, high = np.searchsorted(at, block * half), np.searchsorted(at, (block + 2) * half)
    hit, of = spans(low, high - low)
    wanted, good = index.phrases[k[of]], np.ones(len(hit), bool)
    padded_at, padded_rank = np.append(at, np.full(PHRASE, -1)), np.append(rank, np.full(PHRASE, -1))
    for w in range(PHRASE):
        good &= (wanted[:, w] < 0) | ((padded_at[hit + w] == at[hit] + w) & (padded_rank[hit + w] == wanted[:, w]))
    found = np.unique(np.stack([at[hit[good]], k[of[good]]], 1), axis=0)
    return found[:, 0], found[:, 1]


def matches(index: Index, tokens: np.ndarray, bounds: np.ndarray):
    """Of some texts' words: (text, template, start, end, common words) of all matches, by text."""
    t = index.templates
    step = int(t.half.max())
    base = np.concatenate([[0], np.cumsum((np.diff(bounds) // step + 3) * step)])  # no block reaches into another text
    hit, word = t.hits(tokens)
    text = np.searchsorted(bounds, hit, "right") - 1
    at, rank = base[text] + hit - bounds[text], index.rank[word]
    rows = []
    for half, vocabulary, edges, template, place in index.classes:
        block, k, common = joined(index, half, vocabulary, edges, template, place, at, rank, base[text])
        exact = t.phrase[k]
        where, which = places(index, half, block[exact], k[exact], at, rank)
        rows.append(np.stack([where, which, where + np.array([len(w) for w in t.words])[which], t.m[which]], 1))
        rows.append(np.stack([block[~exact] * half, k[~exact], (block[~exact] + 2) * half, common[~exact]], 1))
    start, k, end, common = np.concatenate(rows).T if rows else np.zeros((4, 0), np.int64)
    text = np.searchsorted(base, start, "right") - 1
    order = np.lexsort((k, start, text))
    text = text[order]
    end = np.minimum(end[order] - base[text], np.diff(bounds)[text])
    return text, k[order], start[order] - base[text], end, common[order]


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, at = texts_of(column)
    for i, j in sliced(at, SLICE_BYTES):
        yield i, *hashed(_AS[data[at[i] : at[j]]], at[i : j + 1] - at[i])


def _count(batches, templates):
    total = np.zeros(len(templates.vocabulary), np.int64)
    for batch in batches:
        for _, tokens, _ in _words(batch.column(0)):
            total += np.bincount(templates.hits(tokens)[1], minlength=len(total))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["word", "n"])


def _scan(batches, index, kept):
    labels = np.array(index.templates.labels, object)
    for batch in batches:
        n, size, rows = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), []
        for i, tokens, bounds in _words(batch.column(kept)):
            n[i : i + len(bounds) - 1] = np.diff(bounds)
            text, k, start, end, common = matches(index, tokens, bounds)
            size[i : i + len(bounds) - 1] = np.bincount(text, minlength=len(bounds) - 1)
            rows.append((k, start, end, common))
        k, start, end, common = (np.concatenate(x) for x in zip(*rows)) if rows else np.zeros((4, 0), np.int64)
        found = pa.StructArray.from_arrays([pa.array(k, pa.int32()), pa.array(labels[k], pa.string()), pa.array(start), pa.array(end),
                                            pa.array(common / index.templates.m[k], pa.float64())], fields=list(_FOUND))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), found)
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(n), lists], names=[*batch.schema.names[:kept], "n_words", "found"])


def scan(df: DataFrame, keep: list[str], text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, containment=CONTAINMENT) -> DataFrame:
    """The columns ``keep`` of all rows of ``df``, the number of words, and all matches: template
    (its place in the list), label, first word and end of the block or phrase, containment."""
    ship(df.sparkSession)
    known = Templates(templates, containment)
    source = F.coalesce(col(text), F.lit("")).alias("text")
    counted = df.select(source).mapInArrow(lambda rows: _count(rows, known), "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    index = Index(known, dict(map(tuple, counted.collect())))  # one row for each word of the templates
    rows = df.select(*map(col, keep), source)
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[: len(keep)]) + f", n_words bigint, found {FOUND}"
    return rows.mapInArrow(lambda batches: _scan(batches, index, len(keep)), schema)


def op11_template_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written once: digests are several columns over the same matches.
    found = Scratch(spark, "licenses").save(scan(documents(spark, sf_dir), ["doc_id"]))
    base = F.filter("found", lambda m: m["template"] < len(BASE))
    listed = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")
    return (found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda m: m["start"])).alias("first_word"), F.array_max(F.transform("base", lambda m: m["start"])).alias("last_word"),
        listed(F.col("base")).alias("base_labels"), listed(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["containment"])), F.lit(0.0)).alias("score")))
