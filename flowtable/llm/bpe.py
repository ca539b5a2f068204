"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut by the pre-tokeniser's pattern; every match is encoded on its
own. A match is encoded by halves, down to single bytes: both halves
recursively, then the two token lists are joined. The join encodes a window
around the border again, at first the two tokens that meet there. A token list
is the BPE encoding of its bytes exactly when every pair of neighbours encodes
to itself, so the tokens outside the window are proven stable as soon as the
pairs at the window's two edges do; until then the window grows on the side
that fails. Decoding concatenates up a balanced tree.

The left half has the largest power of two of bytes below the whole, so the
same halves come up again and again. Results are remembered in three tables of
fixed size: by the two tokens that meet at a border, by the bytes of a short
half, and by the whole match.

The rank file is read once per Python worker from ``path`` (installed on every
node). Memory is bounded by one text plus the tables. The pattern's classes
are written out as ranges for the standard library's engine, which is twice as
fast as ``regex`` and finds the same matches.

Defined cases: null text is empty and has no tokens; texts may have any length;
strings of special tokens are ordinary text; unknown ids or null lists decode
to nothing; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from array import array
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowtable.llm.common import with_arrow_column

CACHE = 100_000  # entries of a table, in each of two generations


def splitter(pattern: str):
    """text -> the matches of ``pattern`` as the ``regex`` module finds them."""
    import regex

    general = regex.compile(pattern).findall
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x10000))))

    def ranges(kind: str) -> str:
        return "".join(f"{re.escape(m[0][0])}-{re.escape(m[0][-1])}" for m in regex.finditer(f"{kind}+", every))

    out, inside = [], False
    for part in regex.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, regex.DOTALL):
        if part in ("[", "]"):
            inside = part == "["
        elif part[:2] in (r"\p", r"\P", r"\s", r"\S", r"\w", r"\W", r"\d", r"\D"):
            part = ranges(part) if inside else f"[{ranges(part)}]"
        out.append(part)
    plain = re.compile("".join(out)).findall
    wide = re.compile("[\U00010000-\U0010FFFF]").search

    def split(text: str) -> list[str]:
        return plain(text) if text.isascii() or not wide(text) else general(text)

    return split


class Table(dict):
    """Values by key, made when missing. A full generation is set aside and
    serves misses of the next one, so frequent keys stay. Keys longer than
    ``longest`` are not kept."""

    def __init__(self, make, longest: int):
        super().__init__()
        self.make, self.longest, self.old = make, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Bpe:
    """Ranks of a byte-level BPE vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.split = splitter(pattern)
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        # What the two tokens at a border encode to; halves; whole matches.
        self.borders = Table(lambda pair: self.window(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]), 2)
        self.halves = Table(self.half, 16)
        self.pieces = Table(lambda piece: self.half(piece.encode()), 64)
        self.joins = 0

    def window(self, piece: bytes) -> tuple[int, ...]:
        """The tokens of the bytes at a border: the lowest-ranked neighbours
        merge, leftmost first, to the end."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return (ranks[piece],)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
        heap = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := piece[i:i + 2]) in ranks]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, stop = pop(heap)
            j = end[i]
            if j == 0 or j >= n or end[j] != stop:
                continue  # one of the two parts has changed since
            end[i], end[j] = stop, 0  # 0: no part starts at j any more
            if stop < n:
                before[stop] = i
                wider = piece[i:end[stop]]
                if wider in ranks:
                    push(heap, (ranks[wider], i, end[stop]))
            j = before[i]
            if j >= 0:
                wider = piece[j:stop]
                if wider in ranks:
                    push(heap, (ranks[wider], j, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def join(self, left: tuple, right: tuple) -> tuple[int, ...]:
        """The encoding of the concatenation of two encoded byte strings."""
        if not left or not right:
            return left + right
        self.joins += 1
        a, b = left[-1], right[0]
        window = self.borders[a, b]
        if len(window) == 2 and window[0] == a:
            return left + right
        i, j, borders = 1, 1, self.borders  # tokens of each side inside the window
        while True:
            left_ok = i == len(left) or borders[left[-i - 1], window[0]] == (left[-i - 1], window[0])
            right_ok = j == len(right) or borders[window[-1], right[j]] == (window[-1], right[j])
            if left_ok and right_ok:
                return left[:len(left) - i] + window + right[j:]
            i = i if left_ok else min(len(left), 2 * i)
            j = j if right_ok else min(len(right), 2 * j)
            window = self.window(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j])))

    def half(self, piece: bytes) -> tuple[int, ...]:
        """The encoding of the bytes: of both halves, joined."""
        n = len(piece)
        if n < 2:
            return (self.ranks[piece],) if piece else ()
        mid = 1 << (n - 1).bit_length() - 1
        return self.join(self.halves[piece[:mid]], self.halves[piece[mid:]])

    def encode(self, text: str) -> list[int]:
        return list(self.tokens(text))

    def tokens(self, text: str):
        """The ids one by one."""
        return chain.from_iterable(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids, lo: int = 0, hi: int | None = None) -> bytes:
        """The bytes of ``ids[lo:hi]``, concatenated up a balanced tree."""
        hi = len(ids) if hi is None else hi
        if hi - lo <= 4096:
            return b"".join(map(self.bytes_of.get, ids[lo:hi], repeat(b"")))
        mid = (lo + hi) // 2
        return self.decode(ids, lo, mid) + self.decode(ids, mid, hi)


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` in a column ``ids``."""
    def make(column: pa.Array) -> pa.Array:
        bpe, offsets, flat = load(path, pattern), [0], array("i")
        for t in column.to_pylist():
            flat.extend(bpe.tokens(t or ""))
            offsets.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(flat, np.int32)))

    return with_arrow_column(df, text, ids, T.ArrayType(T.IntegerType()), make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the token ids in a binary column ``out``."""
    def make(column: pa.Array) -> pa.Array:
        bpe = load(path, pattern)
        values = column.flatten().to_numpy(zero_copy_only=False).tolist()
        lengths = [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
        found, at = [], 0
        for n in lengths:
            found.append(bpe.decode(values, at, at + n))
            at += n
        return pa.array(found, pa.binary())

    return with_arrow_column(df, ids, out, T.BinaryType(), make)
