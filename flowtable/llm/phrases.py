"""Phrase collocation mining with double-array tries of Apriori-safe candidates.

Words are cut inside pieces (runs without ``[.,;:!?\\x0A-\\x0D]``); a phrase is
a run of 1 to ``LONGEST`` words of one piece. Passes over the texts:

1. Filter. Words and pairs of words are hashed, and small saturating counters
   of the hashes are added up. The hashes are dealt into lanes, as many as the
   input needs, and a task adds up a lane, so that no counters are shared by
   more phrases when the input grows; a task that reads texts counts what it
   holds before it gives it out. A second pass does the same for the phrases
   of 3 and more words whose pairs may all be frequent. The hashes that reach
   ``least`` set two bits each in a table for their length, which is sent to
   all tasks. A phrase without both its bits occurs less often than that.
2. Candidates. A phrase is a candidate if it has its bits, and so have both
   its parts one word shorter (and so all its parts). Since a
   phrase is never more frequent than its parts, no frequent phrase is lost.
   A task gives each of its candidates out once, whatever its number of texts.
3. Counting. The distinct candidates of each language are dealt into shards,
   each a double-array trie over the shard's own word codes, built in a task.
   Tries are broadcast in packs of a bounded size, and the states of all text
   positions advance through a trie together, one word a level; accepting
   states are counted per task with ``bincount`` and summed.

Counts are exact whatever the hashes do: words are compared as strings when a
trie gives them codes. Steps 2 and 3 run in as many tasks as the cluster has
cores, so that one set of candidates, or one vector of counts, serves all texts
that a core reads. All inputs go this way, whatever their size and ``least``.

Per language: n counts all words, f(phrase) all occurrences, overlaps
included. A candidate of 2 or more words with a = f >= ``least`` is cut after
its first k words into parts of l and r occurrences and scores
floor(1000 a n / (l r)), in decimals of 38 digits; the lowest cut counts, ties
to the smaller k. A phrase inside a longer candidate that is as frequent
(``absorb``) is dropped.

Defined cases: null text is empty; null lang is ``und``; texts of any length
are read whole; repeated rows count as often as they occur; ties go by phrase
in byte order; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtable.llm import arrow_text as at
from flowtable.llm.common import materialize
from flowtable.session import cluster_cores

LEAST = 100
LONGEST = 5
TOP = 2000
LANE_BYTES = 16 << 20  # text bytes for each lane of the filter
FILTER_BYTES = 8 << 20  # hashes of a length that a task holds before it gives them out
KEY = np.uint64((1 << 32) - 1)  # the part of a hash that is counted in its lane
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28  # of the table of a length
BITS_A_KEY = 64
SHARD_BYTES = 4 << 20  # candidates in a trie
PACK_BYTES = 32 << 20  # tries in a broadcast
DISTINCT_BYTES = 64 << 20  # distinct candidates that a task holds
DISTINCT_ROWS = 1 << 16  # fewest new ones that are merged with them, most in an output batch

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a table of ``bits``."""
    last, key = np.uint64(bits - 1), h & KEY
    return (key & last).astype(np.int64), (at.mix(key) & last).astype(np.int64)


def _marked(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have both their bits set."""
    ok = np.ones(len(h), dtype=bool)
    for slot in _slots(h, 8 * len(table)):
        ok &= (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
    return ok


def _mark(table: np.ndarray, h: np.ndarray) -> None:
    for slot in _slots(h, 8 * len(table)):
        np.bitwise_or.at(table, slot >> 3, (128 >> (slot & 7)).astype(np.uint8))


class Words:
    """The words of a slice of texts: byte ranges, rows, and whether the next
    word follows in the same piece."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.data, self.rows = at.LOWER[data], len(offsets) - 1
        self.starts, self.ends, first = at.word_bounds(offsets, data, _SEPARATOR)
        self.row = np.repeat(np.arange(self.rows), np.diff(first))
        piece = np.concatenate([[0], np.cumsum(_BREAK[data])])[self.starts]
        self.follows = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])

    def strings(self) -> pa.DictionaryArray:
        """The words, lower-cased, as a dictionary array."""
        return at.word_array(self.data, self.starts, self.ends).dictionary_encode()

    def phrases(self, seed: np.uint64, flags: dict[int, np.ndarray], longest: int):
        """For each length: (length, positions, hashes) of the phrases whose
        parts pass ``flags``, and which pass them where their length is there."""
        words = at.range_hashes(self.data, self.starts, self.ends)
        h, where = at.mix(words + seed), np.arange(len(words))
        for size in range(1, longest + 1):
            if size > 1:
                passed = np.zeros(len(words) + 1, dtype=bool)
                passed[where] = True
                ok = where < len(words) - size + 1
                h, where = h[ok], where[ok]
                ok = self.follows[where + size - 2] & passed[where + 1]
                h, where = h[ok], where[ok]
                h = at.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[where + size - 1])
            if size in flags:
                ok = _marked(flags[size], h)
                h, where = h[ok], where[ok]
            yield size, where, h


def _by_lang(batch: pa.RecordBatch):
    """(lang, Words) of runs of rows of one language."""
    langs = batch.column("lang")
    for lang in pc.unique(langs).to_pylist():
        column = batch.filter(pc.equal(langs, lang)).column("text")
        for _, _, offsets, data in at.slices(column):
            yield lang, Words(offsets, data)


def _seed(lang: str) -> np.uint64:
    return at.string_hashes([lang.encode()])[0]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), docs["text"].alias("text")) \
        .filter("text is not null and text <> ''")


def _lane_rows(texts: DataFrame, most: int, lanes: int, sizes: list[int], known: dict[int, np.ndarray], held: int) -> DataFrame:
    """The hashes of each length by lane with their counts, each once for what
    a task holds; and (size and lane 0) the number of words of each language."""
    sent = texts.sparkSession.sparkContext.broadcast(known)
    kind = np.uint8 if most < 256 else np.uint32

    def give(size, found):
        h = np.concatenate(found)
        found.clear()
        h.sort()
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        counts = np.minimum(np.diff(first, append=len(h)), most).astype(kind)
        h = h[first]
        border = np.searchsorted(h, np.arange(lanes, dtype=np.uint64) << np.uint64(32))
        border = np.append(border, len(h))
        h = (h & KEY).astype(np.uint32)
        binary = lambda x: pa.Array.from_buffers(
            pa.binary(), lanes, [None, pa.py_buffer((border * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
        batch = pa.RecordBatch.from_arrays(
            [pa.array([size] * lanes, pa.int32()), pa.array(np.arange(lanes), pa.int32()), pa.nulls(lanes, pa.string()),
             pa.nulls(lanes, pa.int64()), binary(h), binary(counts)], names=["size", "lane", "lang", "n", "keys", "counts"])
        return batch.filter(pa.array(np.diff(border) > 0))

    def run(batches):
        own = {size: [] for size in sizes}
        room = {size: held for size in sizes}
        n: dict[str, int] = {}
        for batch in batches:
            for lang, words in _by_lang(batch):
                n[lang] = n.get(lang, 0) + len(words.starts)
                for size, _, h in words.phrases(_seed(lang), sent.value, sizes[-1]):
                    if size in own and len(h):
                        own[size].append(h & np.uint64((lanes << 32) - 1))
                        room[size] -= h.nbytes
                        if room[size] < 0:
                            yield give(size, own[size])
                            room[size] = held
        for size, found in own.items():
            if found:
                yield give(size, found)
        m = len(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * m, pa.int32()), pa.array([0] * m, pa.int32()), pa.array(list(n), pa.string()),
             pa.array(list(n.values()), pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())],
            names=["size", "lane", "lang", "n", "keys", "counts"])

    return texts.mapInArrow(run, "size int, lane int, lang string, n long, keys binary, counts binary")


def _filter(texts: DataFrame, least: int, lanes: int, sizes: list[int], known: dict[int, np.ndarray], held: int):
    """(n per lang, {length: bits of the hashes that reach ``least``})."""
    most = min(max(least, 1), int(KEY))
    kind = np.uint8 if most < 256 else np.uint32

    def add(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        if not size:
            n = table.group_by("lang").aggregate([("n", "sum")])
            return pa.table([pa.array([0] * len(n), pa.int32()), n.column("lang"), n.column("n_sum"), pa.nulls(len(n), pa.binary())],
                            names=["size", "lang", "n", "keys"])
        keys, counts = (np.concatenate([np.frombuffer(v.as_buffer(), of) for v in table.column(name)])
                        for name, of in (("keys", np.uint32), ("counts", kind)))
        at.release()
        both = keys.astype(np.uint64)
        both <<= np.uint64(32)
        both |= counts
        both.sort()
        key = both >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key = key[first][np.add.reduceat(both & KEY, first) >= most]
        return pa.table([pa.array([size], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()),
                         pa.array([key.astype(np.uint32).tobytes()], pa.binary())], names=["size", "lang", "n", "keys"])

    made = materialize(_lane_rows(texts, most, lanes, sizes, known, held).groupBy("size", "lane").applyInArrow(
        add, "size int, lang string, n long, keys binary"), "phrase-filter")
    keys = made.filter("size > 0")
    flags = {size: np.zeros(MIN_BITS // 8, dtype=np.uint8) for size in sizes}
    for r in keys.groupBy("size").agg((F.sum(F.length("keys")) / 4).cast("long").alias("keys")).collect():
        flags[r["size"]] = np.zeros(min(MAX_BITS, max(MIN_BITS, 1 << (BITS_A_KEY * r["keys"]).bit_length())) // 8, dtype=np.uint8)
    for r in keys.select("size", "keys").toLocalIterator():
        _mark(flags[r["size"]], np.frombuffer(r["keys"], np.uint32).astype(np.uint64))
    return made.filter("size = 0").select("lang", "n"), flags


def _distinct(coded: pa.DictionaryArray, where: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
    """(phrases, counts) of the distinct runs of ``size`` words that start at
    the positions ``where``, words joined by spaces."""
    codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    key = codes[where]
    for j in range(1, size):  # pairs of (what came before, next word), numbered anew
        _, key = np.unique(key, return_inverse=True)
        key = key * len(names) + codes[where + j]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    parts = [names.take(pa.array(codes[where[first] + j])) for j in range(size)]
    joined = pc.binary_join_element_wise(*parts, pa.scalar(" ", names.type)) if size > 1 else parts[0]
    return joined.cast(pa.string()), counts


class _Distinct:
    """The distinct phrases that a task has found so far. It is emptied when
    they exceed ``most`` bytes: then some come out again, and none is lost."""

    def __init__(self, most: int):
        self.most, self.kept, self.new = most, {}, {}
        self.rows = self.new_rows = 0

    def add(self, lang: str, found: pa.Array):
        self.new.setdefault(lang, []).append(found)
        self.new_rows += len(found)
        if self.new_rows > max(DISTINCT_ROWS, self.rows):
            self._merge()
            if sum(a.nbytes for a in self.kept.values()) > self.most:
                yield from self.rest()

    def _merge(self) -> None:
        for lang, found in self.new.items():
            parts = [a.cast(pa.large_string()) for a in found]
            if lang in self.kept:
                parts.append(self.kept[lang])
            self.kept[lang] = pa.concat_arrays(parts).unique()
        self.rows = sum(map(len, self.kept.values()))
        self.new, self.new_rows = {}, 0

    def rest(self):
        self._merge()
        for lang, found in self.kept.items():
            for i in range(0, len(found), DISTINCT_ROWS):
                part = found.slice(i, DISTINCT_ROWS).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part], names=["lang", "phrase"])
        self.kept, self.rows = {}, 0


def _candidate_rows(texts: DataFrame, flags: dict[int, np.ndarray], most: int = DISTINCT_BYTES) -> DataFrame:
    """(lang, phrase) of every task's candidates, each once a task: slices
    share most of them, so rows by slice would grow faster than the input."""
    sent = texts.sparkSession.sparkContext.broadcast(flags)

    def run(batches):
        own = _Distinct(most)
        for batch in batches:
            for lang, words in _by_lang(batch):
                coded = words.strings()
                for size, where, _ in words.phrases(_seed(lang), sent.value, LONGEST):
                    if not len(where):
                        break
                    yield from own.add(lang, _distinct(coded, where, size)[0])
        yield from own.rest()

    return texts.mapInArrow(run, "lang string, phrase string")


def _candidates(texts: DataFrame, flags: dict[int, np.ndarray]) -> DataFrame:
    """(lang, phrase): the second step."""
    return materialize(_candidate_rows(texts, flags).distinct(), "phrase-candidates")


class Trie:
    """A double-array trie over word codes. State 0 is the root; ``step`` goes
    to ``base[state] + code`` if that slot's ``check`` names the state, and
    else to ``dead``. Code 0 is any word that the trie does not know."""

    def __init__(self, phrases: list[str]):
        split = [p.split(" ") for p in phrases]
        self.words = sorted({w for p in split for w in p})
        code = {w: i + 1 for i, w in enumerate(self.words)}
        top = len(self.words) + 1
        children: dict[int, dict[int, int]] = {}
        nodes = [[code[w] for w in p] for p in split]
        # Nodes of the trie in the order of their first appearance; 0 is the root.
        ends, count = [], 1
        for p in nodes:
            at_node = 0
            for c in p:
                own = children.setdefault(at_node, {})
                if c not in own:
                    own[c] = count
                    count += 1
                at_node = own[c]
            ends.append(at_node)
        slot = np.zeros(count, dtype=np.int64)
        size = top + 2 * count + 16
        used = np.zeros(size + top, dtype=bool)
        used[0] = True
        base = np.zeros(size + top, dtype=np.int64)
        check = np.full(size + top, -1, dtype=np.int64)
        bases = np.zeros(count, dtype=np.int64)
        many = sorted((n for n in children if n and len(children[n]) > 1), key=lambda n: -len(children[n]))
        used[list(children.get(0, {}))] = True
        start = top  # children of other nodes than the root stand above all codes
        for n in many:
            codes = np.array(sorted(children[n]))
            b = self._place(used, codes, start)
            while b + top + 1 >= len(used):
                used = np.concatenate([used, np.zeros(len(used), dtype=bool)])
            bases[n] = b
            used[b + codes] = True
            while used[start]:
                start += 1
        single = [n for n in children if n and len(children[n]) == 1]
        if len(used) - top < single.__len__() + used.sum():
            used = np.concatenate([used, np.zeros(len(single) + top, dtype=bool)])
        free = np.flatnonzero(~used[top:])[:len(single)] + top
        for n, f in zip(single, free.tolist()):
            bases[n] = f - next(iter(children[n]))
        # Slots of all nodes, then the two arrays.
        for n, own in children.items():
            for c, child in own.items():
                slot[child] = bases[n] + c
        size = int(slot.max(initial=0)) + top + 2
        self.dead = size - 1
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, -1, dtype=np.int32)
        self.base[slot] = bases
        for n, own in children.items():
            self.check[[bases[n] + c for c in own]] = slot[n]
        self.ends = slot[ends]

    @staticmethod
    def _place(used: np.ndarray, codes: np.ndarray, start: int) -> int:
        """The first base (from a free slot on) where all children fit."""
        low = start
        while True:
            free = np.flatnonzero(~used[low:low + 4096]) + low
            bases = free - codes[0]
            bases = bases[bases + codes[-1] < len(used)]
            for c in codes[1:17]:  # a few children rule out most bases
                bases = bases[~used[bases + c]]
            for b in bases.tolist():
                if not used[b + codes].any():
                    return b
            low += 4096
            if low + codes[-1] >= len(used):
                return len(used)  # the caller makes room

    def step(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        to = self.base[state] + codes
        return np.where((self.check[to] == state) & (codes > 0), to, self.dead)

    def count(self, words: Words, codes: np.ndarray, indices: np.ndarray, totals: np.ndarray) -> None:
        """Adds the occurrences of all phrases to ``totals``, by state; the
        word at position i has the trie's code ``codes[indices[i]]``."""
        first = self.step(np.zeros(len(codes), dtype=np.int64), codes)  # once a distinct word
        where = np.flatnonzero((first != self.dead)[indices])
        state = first[indices[where]]
        seen = [state]
        for size in range(2, LONGEST + 1):
            more = where < len(indices) - size + 1
            where, state = where[more], state[more]
            goes = words.follows[where + size - 2]
            where, state = where[goes], state[goes]
            state = self.step(state, codes[indices[where + size - 1]])
            alive = state != self.dead
            where, state = where[alive], state[alive]
            if not len(where):
                break
            seen.append(state)
        totals += np.bincount(np.concatenate(seen), minlength=len(totals))


def _tries(candidates: DataFrame, shard_bytes: int) -> DataFrame:
    """(lang, shard, phrase, slot, trie): a row per candidate with its
    accepting state, and one per shard (phrase null) with the trie."""
    sizes = candidates.groupBy("lang").agg(F.ceil(F.sum(F.octet_length("phrase") + 8) / shard_bytes).alias("shards")) \
        .withColumnRenamed("lang", "l2")
    dealt = candidates.join(F.broadcast(sizes), candidates["lang"] == sizes["l2"]) \
        .select("lang", F.pmod(F.xxhash64("phrase"), F.col("shards")).alias("shard"), "phrase")

    def build(table: pa.Table) -> pa.Table:
        phrases = sorted(table.column("phrase").to_pylist())
        trie = Trie(phrases)
        m = len(phrases)
        slots, trie.ends = trie.ends, None
        return pa.table([pa.array([table.column("lang")[0].as_py()] * (m + 1)), pa.array([table.column("shard")[0].as_py()] * (m + 1)),
                         pa.array([*phrases, None], pa.string()), pa.array([*slots.tolist(), None], pa.int64()),
                         pa.array([None] * m + [pickle.dumps(trie)], pa.binary())], names=["lang", "shard", "phrase", "slot", "trie"])

    return materialize(dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard long, phrase string, slot long, trie binary"), "tries")


def _pack(rows) -> tuple[list[str], dict[tuple[str, int], Trie]]:
    """(the words of all tries, the tries by language and shard); a trie's
    words are numbered from 1 as they stand in the first."""
    tries = {(r.lang, r.shard): pickle.loads(bytes(r.trie)) for r in rows}
    names = sorted({w for t in tries.values() for w in t.words})
    number = {w: i + 1 for i, w in enumerate(names)}
    for t in tries.values():
        t.words = np.array([number[w] for w in t.words], dtype=np.int32)
    return names, tries


def _trie_counts(texts: DataFrame, tries: DataFrame, pack_bytes: int) -> DataFrame:
    """(lang, phrase, f) of all candidates: the third pass, once per pack."""
    made = tries.filter("trie is not null").select("lang", "shard", "trie")
    sizes = sorted((r.lang, r.shard, r.size) for r in made.select("lang", "shard", F.length("trie").alias("size")).collect())
    packs: list[list] = []
    room = 0
    for lang, shard, size in sizes:
        if not packs or size > room:
            packs.append([])
            room = pack_bytes
        packs[-1].append((lang, shard))
        room -= size
    parts = []
    for pack in packs:
        inside = F.lit(False)
        for lang, shard in pack:
            inside = inside | ((F.col("lang") == lang) & (F.col("shard") == shard))
        sent = texts.sparkSession.sparkContext.broadcast(_pack(made.filter(inside).toLocalIterator()))

        def run(batches, sent=sent):
            names, own = sent.value
            known = {w: i + 1 for i, w in enumerate(names)}
            codes, totals = {}, {}
            for k, trie in own.items():
                codes[k] = np.zeros(len(names) + 1, dtype=np.int32)
                codes[k][trie.words] = np.arange(1, len(trie.words) + 1)
                totals[k] = np.zeros(len(trie.base), dtype=np.int64)
            for batch in batches:
                for lang, words in _by_lang(batch):
                    if not len(words.starts):
                        continue
                    coded = words.strings()
                    names_here = np.array([known.get(w, 0) for w in coded.dictionary.to_pylist()], dtype=np.int64)
                    indices = coded.indices.to_numpy()
                    for (l, s), trie in own.items():  # noqa: E741
                        if l == lang:
                            trie.count(words, codes[l, s][names_here], indices, totals[l, s])
            for (lang, shard), total in totals.items():
                slot = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(slot), pa.string()), pa.array([shard] * len(slot), pa.int64()),
                     pa.array(slot, pa.int64()), pa.array(total[slot])], names=["lang", "shard", "slot", "c"])

        langs = sorted({lang for lang, _ in pack})
        parts.append(texts.filter(F.col("lang").isin(langs)).mapInArrow(run, "lang string, shard long, slot long, c long")
                     .groupBy("lang", "shard", "slot").agg(F.sum("c").alias("f")))
    if not parts:
        return tries.select("lang", "phrase", F.col("slot").alias("f")).limit(0)
    total = parts[0]
    for part in parts[1:]:
        total = total.unionAll(part)
    return tries.filter("phrase is not null").select("lang", "shard", "slot", "phrase").join(total, ["lang", "shard", "slot"]) \
        .select("lang", "phrase", "f")


def phrase_counts(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES, pack_bytes: int = PACK_BYTES,
                  filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and (lang, phrase, f): all phrases with f >= ``least``."""
    texts = _texts(docs)
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("b")).first()["b"] or 0
    lanes = 1 << (size // LANE_BYTES).bit_length()
    sizes, flags = _filter(texts, least, lanes, [1, 2], {}, filter_bytes)
    flags |= _filter(texts, least, lanes, list(range(3, LONGEST + 1)), flags, filter_bytes)[1]
    texts = texts.coalesce(cluster_cores(docs.sparkSession))
    tries = _tries(_candidates(texts, flags), shard_bytes)
    counts = _trie_counts(texts, tries, pack_bytes)
    return sizes, materialize(counts.filter(F.col("f") >= least), "frequent-phrases")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, absorb: tuple[int, int] = (100, 100), **sizes) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang, rank, phrase, a, l,
    r, n, score``. ``absorb`` = (p, q): a phrase is dropped if a longer
    candidate around it has p * f(longer) >= q * a."""
    n, frequent = phrase_counts(docs, least, **sizes)
    split = F.split("phrase", " ")
    sized = frequent.withColumn("w", split).withColumn("size", F.size("w"))
    longer = sized.filter("size > 1")
    # Cuts, each part with its count (a part of a frequent phrase is frequent).
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    joined = lambda words: F.array_join(words, " ")
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.slice("w", F.lit(1), F.col("k"))).alias("first"),
                       joined(F.slice("w", F.col("k") + 1, F.size("w"))).alias("rest"))
    part = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(F.broadcast(n), "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("over", (wide("a") * wide("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)")) \
        .withColumn("under", wide("l") * wide("r")).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # The smallest longer candidates around a phrase add one word.
    p, q = absorb
    around = sized.filter("size > 2").select("lang", "f", F.explode(F.array(
        joined(F.slice("w", F.lit(1), F.col("size") - 1)), joined(F.slice("w", F.lit(2), F.col("size"))))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * p < F.col("a") * q))
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), "phrase")
    return left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n",
        F.col("b.score").alias("score"))
