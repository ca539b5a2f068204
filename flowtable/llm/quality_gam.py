"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives ``FEATURES`` from its characters, words and lines. Every
feature is cut into quantile bins; boosting visits the features in turn, fits a
shallow tree to the current residuals over that feature's bins and adds it to
the feature's lookup table, round after round. Then the pairs of features that
best explain what is left get two-way tables, boosted in the same cyclic way.
A score is the sum of table entries, put through the logistic function.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``, a few
hundred kilobytes of numbers); every text is scored whole, in Arrow batches.

Defined cases: null text is empty and gets a score; texts of any length are
read whole; repeated rows get equal scores; without labelled rows of both
classes every score is 0.5; an empty table gives no rows; other columns pass
through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowtable.llm import arrow_text as at
from flowtable.llm.common import with_arrow_column
from flowtable.llm.labelled import sample

SAMPLE = 12_000  # labelled rows the model is fitted on, at most
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.15
FEATURES = ("words", "bytes_a_word", "symbols", "upper", "digits", "marks", "pipes", "non_ascii", "stops",
            "short_words", "distinct_words", "same_as_before", "repeated_fives", "words_a_line", "repeated_lines")

_CLASSES = np.zeros((7, 256))
for _i, _chars in enumerate((b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58)), b"!?", b"|",
                             bytes(range(128, 256)), b".,;:")):
    _CLASSES[_i, list(_chars)] = 1


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of numbers per text of the slice."""
    rows = len(offsets) - 1
    size = np.maximum(1, np.diff(offsets))
    starts, ends, first = at.word_bounds(offsets, data)
    n = np.diff(first)
    some = np.maximum(1, n)
    out = np.zeros((rows, len(FEATURES)))
    out[:, 0] = np.log1p(n)
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    out[:, 1] = np.diff(length[first]) / some
    for i, column in enumerate((2, 3, 4, 5, 6, 7, 8)):
        total = np.concatenate([[0], np.cumsum(_CLASSES[i][data])])
        out[:, column] = np.diff(total[offsets]) / size
    short = np.concatenate([[0], np.cumsum(ends - starts <= 3)])
    out[:, 9] = np.diff(short[first]) / some
    words = at.word_hashes(data, starts, ends)
    fives = at.shingle_hashes(words, 5)
    again = np.zeros(len(words) + 1)
    again[2:] = np.cumsum(words[1:] == words[:-1]) if len(words) > 1 else 0
    breaks = data == 10
    line = np.concatenate([[0], np.cumsum(breaks)])
    out[:, 13] = np.log1p(n / (np.diff(line[offsets]) + 1))
    out[:, 11] = (again[first[1:]] - again[np.minimum(first[:-1] + 1, first[1:])]) / some
    for r in range(rows):
        a, b = first[r], first[r + 1]
        if b > a:
            out[r, 10] = len(np.unique(words[a:b])) / (b - a)
        if b - a >= 6:
            out[r, 12] = 1 - len(np.unique(fives[a:b - 4])) / (b - a - 4)
        lines = [x for x in data[offsets[r]:offsets[r + 1]].tobytes().split(b"\n") if x]
        if lines:
            out[r, 14] = 1 - len(set(lines)) / len(lines)
    return out


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Leaf values per bin of a shallow tree over ordered bins: the best cut is
    made again and again until there are ``leaves`` leaves."""
    parts = [(0, len(grad))]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            won = gain(a, cut) + gain(cut, b) - gain(a, b)
            i = int(np.argmax(won))
            if won[i] > best[0]:
                best = (won[i], (a, b), int(cut[i]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Gam:
    """Bin edges, one table per feature and one per chosen pair."""

    def __init__(self, edges, coarse, tables, pairs, pair_tables, bias):
        self.edges, self.coarse, self.tables = edges, coarse, tables
        self.pairs, self.pair_tables, self.bias = pairs, pair_tables, bias

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            z += table[np.searchsorted(self.coarse[f], x[:, f], "right"),
                       np.searchsorted(self.coarse[g], x[:, g], "right")]
        return _sigmoid(z)


def fit(x: np.ndarray, y: np.ndarray) -> Gam | None:
    if len(set(y.tolist())) < 2:
        return None
    d = x.shape[1]

    def edges(bins: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) for f in range(d)]

    fine, coarse = edges(BINS), edges(PAIR_BINS)
    bins = [np.searchsorted(fine[f], x[:, f], "right") for f in range(d)]
    wide = [np.searchsorted(coarse[f], x[:, f], "right") for f in range(d)]
    tables = [np.zeros(len(e) + 1) for e in fine]
    bias = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(len(y), bias)
    for _ in range(ROUNDS):
        for f in range(d):
            p = _sigmoid(z)
            step = RATE * _tree(np.bincount(bins[f], y - p, len(tables[f])),
                                np.bincount(bins[f], p * (1 - p), len(tables[f])))
            tables[f] += step
            z += step[bins[f]]
    # Pairs by what a full two-way table would still gain.
    p = _sigmoid(z)
    gains = []
    for f in range(d):
        for g in range(f + 1, d):
            cell = wide[f] * (len(coarse[g]) + 1) + wide[g]
            grad, hess = np.bincount(cell, y - p), np.bincount(cell, p * (1 - p))
            gains.append((float((grad ** 2 / (hess + 1.0)).sum()), f, g))
    pairs = [(f, g) for _, f, g in sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:PAIRS]]
    pair_tables = [np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)) for f, g in pairs]
    for _ in range(PAIR_ROUNDS):
        for (f, g), table in zip(pairs, pair_tables):
            p = _sigmoid(z)
            cell = wide[f] * table.shape[1] + wide[g]
            grad = np.bincount(cell, y - p, table.size).reshape(table.shape)
            hess = np.bincount(cell, p * (1 - p), table.size).reshape(table.shape)
            # A shallow tree: one cut on the first feature, a tree on the second below each side.
            cut = int(np.argmax(np.abs(np.cumsum(grad.sum(1)))[:-1])) + 1 if table.shape[0] > 1 else 1
            step = np.zeros_like(table)
            for part in (slice(0, cut), slice(cut, None)):
                if grad[part].size:
                    step[part] = _tree(grad[part].sum(0), hess[part].sum(0), leaves=2)
            table += RATE * step
            z += RATE * step[wide[f], wide[g]]
    return Gam(fine, coarse, tables, pairs, pair_tables, bias)


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, where=None) -> Gam | None:
    """The model of a bounded sample: at most ``limit`` rows of numbers reach
    the driver."""
    def run(batches):
        for batch in batches:
            parts = [features(offsets, data) for _, _, offsets, data in at.slices(batch.column("text"))]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(
                list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = sample(docs, labels, "quality", limit, where).mapInArrow(run, "doc_id long, y int, x array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    if not rows:
        return None
    return fit(np.array([r.x for r in rows]), np.array([r.y for r in rows], dtype=float))


def score(docs: DataFrame, model: Gam | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` in a column ``out``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(column: pa.Array) -> pa.Array:
        parts = [np.full(b - a, 0.5) if sent.value is None else sent.value.score(features(offsets, data))
                 for a, b, offsets, data in at.slices(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return with_arrow_column(docs, text, out, T.DoubleType(), make)
