"""Vectorised word cutting and hashing over the byte buffers of Arrow columns.

Words are cut for a whole slice of rows at once. Their names are 64 bits of a
cryptographic hash, taken once per distinct word of the slice
(``word_hashes``); two different words share a name only by chance, whatever
the text says. ``range_hashes`` is a cheap polynomial that can be made to
collide: it serves filters that an exact step follows. Memory is bounded by
``SLICE_BYTES`` (or by one long text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.RandomState(20240229).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)

SPACE = np.zeros(256, dtype=bool)  # the contract's white space: space and 0x09-0x0D
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)  # folds A-Z
LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column, nulls as empty strings."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets from 0, bytes) of runs of rows of at most
    ``limit`` bytes, or of one longer row."""
    if len(column) == 0:
        return
    offsets, data = buffers(column)
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]]
        a = b
    release()


def release() -> None:
    """Gives back the memory that Arrow keeps of earlier batches: workers live
    on from stage to stage."""
    pa.default_memory_pool().release_unused()


def word_bounds(offsets: np.ndarray, data: np.ndarray, separator: np.ndarray = SPACE):
    """(starts, ends, first): byte ranges of the words of all rows, and for
    each row the index of its first word (one more entry than rows)."""
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The byte ranges as an array of strings (or of another ``kind`` with
    64-bit offsets)."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    packed = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    return pa.Array.from_buffers(kind or pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def string_hashes(words: Iterable[bytes]) -> np.ndarray:
    """64 bits of BLAKE2b of each byte string."""
    digest = hashlib.blake2b
    return np.frombuffer(b"".join(digest(w, digest_size=8).digest() for w in words), dtype="<u8").astype(np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit names of the words, equal for equal bytes (after ``fold``)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    coded = word_array(data if fold is None else fold[data], starts, ends, pa.large_binary()).dictionary_encode()
    return string_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte ranges, for filters only: equal bytes
    give equal hashes wherever they stand, but unequal ones can be made to."""
    p, q = powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * p[:-1], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * q[starts])


_WEIGHTS = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word windows of one word-hash array (across row
    borders too: the caller keeps the windows inside its rows)."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    n = len(words) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += words[j:j + n] * _WEIGHTS[j]
    return mix(out)


def whole_hash(words: np.ndarray) -> np.ndarray:
    """One hash for a short word sequence (fewer words than a shingle)."""
    salt = np.full(1, len(words), dtype=np.uint64) * _BASE
    return mix((words * _WEIGHTS[:len(words)]).sum(dtype=np.uint64, keepdims=True) + salt)
