"""Encoding against the reference library, the plain merges, and round trips."""
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.bpe import decode_documents, digest_documents, encode_documents, encoder

from .conftest import SF

E = encoder()
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=E.ranks, special_tokens={})
ODD = " abcde'stre\n\t\r\x1c\x1d\x1e\x1f\x85\xa0　ééß漢字\U0001f642١٢3!?.<|endoftext|>\x00​﻿"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet=ODD)))
def test_same_as_the_library(text):
    ids = E.encode(text)
    assert ids == LIBRARY.encode_ordinary(text) and E.decode(ids).decode() == text


def test_table_is_the_plain_merges_of_every_prefix():
    rnd, tokens = random.Random(4), list(E.ranks)
    for _ in range(400):
        data = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 6)))
        last = E.prefix_tokens(data)
        assert E.read_back(last) == E.merged(data)
        cut = rnd.randint(1, len(data))
        assert E.read_back(last[: cut + 1]) == E.merged(data[:cut])


def test_appends_and_edits_are_exact():
    rnd, tokens, saved = random.Random(5), list(E.ranks), 0
    for _ in range(200):
        data = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 300)))
        last = E.prefix_tokens(data)
        more = rnd.choice(tokens)
        assert E.append(data, list(last), more) == (data + more, E.prefix_tokens(data + more))
        at = rnd.randint(0, len(data))
        upto = rnd.randint(at, min(len(data), at + 9))
        text, table, done = E.edit(data, last, at, upto, more)
        assert text == data[:at] + more + data[upto:] and table == E.prefix_tokens(text)
        saved += done < len(text) - at
    assert saved > 20


def test_long_matches():
    for text in ("a" * 20000, " " * 5000 + "x", "ab" * 5000, "0" * 9999):
        assert E.encode(text) == LIBRARY.encode_ordinary(text)


def test_documents_and_odd_rows(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    coded = decode_documents(encode_documents(docs)).collect()
    for r in coded:
        assert list(r.ids) == LIBRARY.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert sorted(((r.doc_id, r.n_tokens) for r in digest_documents(docs).collect()), key=str) == sorted(((r.doc_id, len(r.ids)) for r in coded), key=str)
    assert digest_documents(none).collect() == []


def test_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError):
        type(E)({b"a": 0}, P.PATTERN)


def test_short_matches_with_memories_that_are_full(monkeypatch):
    """Their tables are filled in only where they are asked for, whatever the memories hold."""
    from tidemark.llm import bpe
    rnd, pieces = random.Random(6), []
    for _ in range(400):
        pieces.append("".join(rnd.choice(["the", "tion", " an", "er", "ß", "漢", "qx", "  ", "9", "é"]) for _ in range(rnd.randint(1, 9))))
    for most in (1, 7, 1000):
        monkeypatch.setattr(bpe, "PREFIXES", most)
        monkeypatch.setattr(bpe, "PAIRS", most)
        one = type(E)(E.ranks, P.PATTERN)
        for piece in pieces:
            assert list(one.piece(piece)) == ([E.ranks[piece.encode()]] if piece.encode() in E.ranks else E.merged(piece.encode()))
        assert 0 < len(one._prefixes) <= most and len(one._apart) <= most
    data = " extraordinarilyunbelievable".encode()
    last = [-1] + [-2] * len(data)
    E.last_token(data, len(data), last)
    assert last[-1] == E.merged(data)[-1] and last.count(-2) > len(data) // 2


def test_memories_can_be_emptied(spark, odd):
    one = type(E)(E.ranks, P.PATTERN)
    text = "The quick brownish foxlets jumpingly overtook lazybones, 12345 times"
    ids = one.encode(text)
    assert one._pieces and one._prefixes and one._apart
    one.forget()
    assert not (one._pieces or one._pieces.older or one._prefixes or one._apart)
    assert one.encode(text) == ids == LIBRARY.encode_ordinary(text)
    assert sorted(digest_documents(odd, keep=False).collect(), key=str) == sorted(digest_documents(odd).collect(), key=str)
