"""Words of whole texts as 64-bit hashes, for many texts at once.

A word is a longest run of bytes other than space and the five controls 0x09 to 0x0D; A to Z
count as a to z. Its hash is a polynomial over a table of random byte values, finished by a
mixer; equal words have equal hashes, and different ones differ but for a chance of about 2**-64
for each pair compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes of text that are hashed in one go (a longer text by itself). A worker keeps 16 bytes of
#: powers for each, and some 30 while it hashes.
SLICE_BYTES = 1 << 19

_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_VALUES = np.random.default_rng(20240229).integers(1 << 62, 1 << 64, 256, np.uint64, endpoint=False)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = _VALUES[_LOWER]
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base, and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, x, np.uint64))])
                      for x in (_BASE, _INVERSE)]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` (uint8), whose texts begin and end at ``bounds``; and the
    bounds of the texts counted in words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    word = _IN_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:n], out=total[1:])
    return (mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)),
            np.searchsorted(start, bounds))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and bounds of an Arrow string column without nulls."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def sliced(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with up to ``limit`` bytes each; a longer text is a run by itself."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of an Arrow string column: the first row, word hashes, bounds in words."""
    data, at = texts_of(column)
    for i, j in sliced(at, SLICE_BYTES):
        yield i, *hashed(data[at[i] : at[j]], at[i : j + 1] - at[i])


def pack(values: np.ndarray) -> bytes:
    """Integers, packed: bytes of equal weight together, then compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def bucket_edges(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys dealt to buckets by their upper bits: the buckets that have some, and the
    edges of their runs."""
    of = bucket_of(keys, buckets)
    at = np.flatnonzero(np.diff(of, prepend=-1))
    return of[at], np.append(at, len(keys))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
