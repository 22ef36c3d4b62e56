"""Fill-in-middle rearrangement of documents by a piece table.

The text of a document and the sentinels are immutable buffers. A document is a list of
descriptors (buffer, start, length), all counted in code points:

1. Cut. The whole text is one descriptor; two cuts split it into prefix, middle and suffix.
   Nothing is copied.
2. Arrange. A form permutes the descriptors and puts descriptors of the sentinels between them:
   ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle, ``plain`` is
   the text. Texts that are empty or hold a sentinel stay plain, so the sentinels of an output
   are its own.
3. Restore. The sentinels found in an output cut it into descriptors over that output; the
   inverse permutation brings them back into the order of the text.
4. Hash. A digest is fed one descriptor's bytes after another; neither the output nor the
   restored text is put together for it.

Cuts and form come from the hex digits of sha256("1:" and the id), so that a lost task gives the
same rows again. Everything is done within a row: no shuffle, no state, memory in proportion to
one batch of documents.

Defined results: a null text counts as empty and is plain; a null id is hashed as no digits; the
length of very long texts is no matter; ties do not arise; repeated rows get equal results; an
empty table gives no rows; extra columns are kept by ``fill_in_middle`` (a new column whose name
clashes gets another one, see ``names``) and not read by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import col, documents, fresh, ship

#: The second buffer: the sentinels, and where each begins in it.
SENTINELS = ("<P>", "<S>", "<M>")
BUFFER = "".join(SENTINELS)
WIDTH = 3
#: Orders of sentinels (their index in the buffer) and of parts (0 prefix, 1 middle, 2 suffix).
FORMS = {"psm": ((0, 0), (1, 2), (2, 1)), "spm": ((1, 2), (0, 0), (2, 1))}
#: Percent of documents that are rearranged, and of these that take the form spm; the seed.
RATE, SPM, SEED = 90, 20, 1

PIECES = "array<struct<buffer:int,start:bigint,length:bigint>>"


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def piece(buffer: int, start: Column, length: Column) -> Column:
    return F.struct(F.lit(buffer).alias("buffer"), start.cast("bigint").alias("start"), length.cast("bigint").alias("length"))


def sentinel(k: int) -> Column:
    return piece(1, F.lit(WIDTH * k), F.lit(WIDTH))


def cut(whole: Column, first: Column, second: Column) -> list[Column]:
    """One descriptor split at two places, counted from its start."""
    start, length = whole["start"], whole["length"]
    return [piece(0, start, first), piece(0, start + first, second - first), piece(0, start + second, length - second)]


def arranged(parts: list[Column], form: str) -> Column:
    """Sentinels and the three parts in the order of a form."""
    return F.array(*[p for s, k in FORMS[form] for p in (sentinel(s), parts[k])])


def names(df: DataFrame) -> dict[str, str]:
    """The names of the columns that ``fill_in_middle`` adds."""
    new = ("n", "form", "prefix_chars", "middle_chars", "pieces")
    taken = {c.lower() for c in df.columns}
    return {x: x if x not in taken else fresh(df, x)[0] for x in new}


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """``df`` with, for each row, the length of its text, the form, the lengths of prefix and
    middle (null if plain), and the descriptors of its output."""
    name = names(df)
    whole, n, digest, cuts = fresh(df, "text", "size", "digest", "cuts")
    source = F.coalesce(col(text), F.lit(""))
    rows = df.select("*", source.alias(whole), F.char_length(source).cast("bigint").alias(n),
                     F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(doc_id).cast("string"), F.lit(""))), 256).alias(digest))
    one, two = (F.pmod(_draw(F.col(digest), k), F.col(n) + 1) for k in (1, 2))
    rows = rows.withColumn(cuts, F.struct(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")))
    a, b = F.col(cuts)["a"], F.col(cuts)["b"]
    plain = (F.col(n) == 0) | (_draw(F.col(digest), 3) % 100 >= rate)
    for mark in SENTINELS:
        plain = plain | F.contains(F.col(whole), F.lit(mark))
    form = F.when(plain, "plain").when(_draw(F.col(digest), 4) % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumn(name["form"], form)
    uncut = piece(0, F.lit(0), F.col(n))
    parts = cut(uncut, a, b)
    form = F.col(name["form"])
    pieces = F.when(form == "plain", F.array(uncut)).when(form == "spm", arranged(parts, "spm")).otherwise(arranged(parts, "psm"))
    length = lambda c: F.when(form != "plain", c)
    return rows.select(*map(col, df.columns), F.col(n).alias(name["n"]), form, length(a).alias(name["prefix_chars"]),
                       length(b - a).alias(name["middle_chars"]), pieces.cast(PIECES).alias(name["pieces"]))


def rendered(text: Column, pieces: Column) -> Column:
    """The output that descriptors stand for."""
    at = lambda buffer, p: F.substr(buffer, (p["start"] + 1).cast("int"), p["length"].cast("int"))
    return F.array_join(F.transform(pieces, lambda p: F.when(p["buffer"] == 0, at(F.coalesce(text, F.lit("")), p)).otherwise(at(F.lit(BUFFER), p))), "")


# ---- descriptors over bytes: streaming digests and restoring -------------------------------

_BUFFER = BUFFER.encode()


def offsets(data: bytes) -> np.ndarray | None:
    """Byte offsets of the code points and of the end; None where each is one byte."""
    if data.isascii():
        return None
    return np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))


def streamed(data: bytes, pieces: list[tuple[int, int, int]]) -> Iterator[memoryview]:
    """The bytes of descriptors, one after another, as views of their buffers."""
    views, at = (memoryview(data), memoryview(_BUFFER)), offsets(data)
    for buffer, start, length in pieces:
        end = start + length
        if buffer == 0 and at is not None:
            start, end = int(at[start]), int(at[end])
        yield views[buffer][start:end]


def restored(output: bytes, form: str) -> list[memoryview]:
    """The parts of an output in the order of the text: prefix, middle, suffix."""
    view = memoryview(output)
    if form == "plain":
        return [view]
    parts, at = [view] * 3, 0
    order = FORMS[form]
    for (mark, k), after in zip(order, [*order[1:], None]):
        start = at + len(SENTINELS[mark])
        at = output.index(SENTINELS[after[0]].encode(), start) if after else len(output)
        parts[k] = view[start:at]
    return parts


def _sha(views) -> str:
    digest = hashlib.sha256()
    for view in views:
        digest.update(view)
    return digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch], kept: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *rest, text, form, pieces = batch.columns
        fields = pieces.flatten()
        buffer, start, length = (f.to_numpy(zero_copy_only=False).tolist() for f in fields.flatten())
        bounds = np.concatenate([[0], np.cumsum(pieces.value_lengths().to_numpy())]).tolist()
        there, back = [], []
        for i, kind in enumerate(form.to_pylist()):
            data = text[i].as_buffer().to_pybytes()
            rows = list(zip(buffer[bounds[i] : bounds[i + 1]], start[bounds[i] : bounds[i + 1]], length[bounds[i] : bounds[i + 1]]))
            there.append(_sha(streamed(data, rows)))
            back.append(_sha(restored(b"".join(streamed(data, rows)), kind)))
        yield pa.RecordBatch.from_arrays([*rest, pa.array(there, pa.string()), pa.array(back, pa.string())],
                                         names=[*batch.schema.names[:kept], "output_sha256", "restored_sha256"])


def digests(found: DataFrame, keep: list[str], text: str, form: str, pieces: str) -> DataFrame:
    """The columns ``keep`` of rows with descriptors, the digest of the output, and that of the
    text rebuilt from the output and the form."""
    ship(found.sparkSession)
    t, f, p = fresh(found, "text", "form", "pieces")
    rows = found.select(*map(col, keep), F.coalesce(col(text), F.lit("")).cast("binary").alias(t), col(form).alias(f), col(pieces).alias(p))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[: len(keep)]) + ", output_sha256 string, restored_sha256 string"
    return rows.mapInArrow(lambda batches: _digests(batches, len(keep)), schema)


def op12_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    return digests(found, ["doc_id", "n", "form", "prefix_chars", "middle_chars"], "text", "form", "pieces")
