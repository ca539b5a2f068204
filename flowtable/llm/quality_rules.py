"""Quality rules: exact text counts with fixed limits, and a logistic
regression over hashed word and character n-grams.

The model is trained on a bounded sample of labelled rows (``SAMPLE``) in one
task: words, word pairs and byte trigrams are hashed into ``DIM`` slots each, a
text's features are the mean weights of its n-grams. A fifth of the sample is
kept out of the fit and calibrates the probabilities (Platt's two numbers).
Every text is scored whole, in Arrow batches, against ``KEEP``.

Defined cases: null text is empty (no words, fails the base rules); texts of
any length are read whole; repeated rows get equal results; without labelled
rows of both classes the model keeps every text; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtable.llm import arrow_text as at
from flowtable.llm.common import with_key
from flowtable.llm.labelled import sample

SAMPLE = 4000  # labelled rows the model is fitted on, at most
DIM = 1 << 15
KEEP = 0.5
MIN_WORDS = 10
WINDOW = 5
SYMBOLS = b"#*$%&|<>"  # fixed values of the rule

ROUNDS = 80


def _slots(data: np.ndarray, offsets: np.ndarray):
    """For word, word-pair and byte-trigram features: (slot of each n-gram,
    row of each n-gram), slots of the three kinds in ranges of their own."""
    starts, ends, first = at.word_bounds(offsets, data)
    words = at.word_hashes(data, starts, ends)
    mask = np.uint64(DIM - 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    yield (words & mask).astype(np.int32), row
    if len(words) > 1:
        same = row[1:] == row[:-1]
        yield ((at.shingle_hashes(words, 2) & mask).astype(np.int32) + DIM)[same], row[1:][same]
    if len(data) > 2:
        wide = data.astype(np.uint32)
        code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
        code = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32) + 2 * DIM
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        same = row[2:] == row[:-2]
        yield code[same], row[2:][same]


def _features(batches):
    """mapInArrow: y and the (slot, weight) features of each sampled text."""
    for batch in batches:
        column, ys = batch.column("text"), batch.column("y")
        slots, weights = [], []
        for a, b, offsets, data in at.slices(column):
            kinds = list(_slots(data, offsets))
            for r in range(b - a):
                s, w = [], []
                for slot, row in kinds:
                    lo, hi = np.searchsorted(row, [r, r + 1])
                    found, count = np.unique(slot[lo:hi], return_counts=True)
                    s.append(found)
                    w.append(count / max(1, hi - lo))
                slots.append(np.concatenate(s).astype(np.int32))
                weights.append(np.concatenate(w).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [ys, pa.array(slots, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))],
            names=["y", "slots", "weights"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b with P(1) = sigmoid(a z + b): a few damped Newton steps on
    smoothed targets."""
    up, n = y.sum(), len(y)
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (n - up + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ ab)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        ab = ab + np.clip(step, -1, 1)
    return float(ab[0]), float(ab[1])


def _fit(t: pa.Table) -> pa.Table:
    """The weights fitted on the whole (bounded) sample, which is one group:
    the last three numbers are bias and calibration. No row without both
    classes."""
    none = pa.table([pa.array([], pa.binary())], names=["model"])
    # Sorted by content, so that the order in which tasks end does not matter.
    order = sorted(range(t.num_rows), key=lambda i: (t["slots"][i].values.to_numpy().tobytes(), t["y"][i].as_py()))
    t = t.take(pa.array(order, pa.int64())).combine_chunks()
    y = t.column("y").to_numpy().astype(float)
    slots = t.column("slots").combine_chunks()
    weights = t.column("weights").combine_chunks()
    counts = np.diff(slots.offsets.to_numpy())
    index, value = slots.flatten().to_numpy(), weights.flatten().to_numpy().astype(np.float64)
    row = np.repeat(np.arange(len(y)), counts)
    if len(set(y)) < 2:
        return none
    held = np.arange(len(y)) % 5 == 4
    # Balanced weights: the rarer class counts as much as the other.
    share = np.where(y == 1, 0.5 / max(1, (y[~held] == 1).sum()), 0.5 / max(1, (y[~held] == 0).sum())) * ~held
    w, bias = np.zeros(3 * DIM), 0.0
    # Rare slots differ in scale; Adam's step is per slot.
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for i in range(1, ROUNDS + 1):
        z = np.bincount(row, value * w[index], len(y)) + bias
        err = (_sigmoid(z) - y) * share
        g = np.bincount(index, value * err[row], 3 * DIM) + 1e-7 * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** i, 1 - 0.99 ** i
        w -= 0.5 * (m / c1) / (np.sqrt(v / c2) + 1e-9)
        bias -= 0.05 * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    z = np.bincount(row, value * w[index], len(y)) + bias
    a, b = _platt(z[held], y[held]) if len(set(y[held])) == 2 else (1.0, 0.0)
    model = np.concatenate([w, [bias, a, b]])
    return pa.table([pa.array([model.tobytes()], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> bytes | None:
    """The fitted model (a fixed 768 KiB), or None without both classes."""
    rows = sample(docs, labels, "quality", limit).mapInArrow(
        _features, "y int, slots array<int>, weights array<float>")
    # One group: however the rows are dealt, one task gets the whole sample.
    found = rows.withColumn("whole", F.lit(0)).groupBy("whole").applyInArrow(_fit, "model binary").collect()
    if len(found) > 1:
        raise RuntimeError("the sample was split")
    return bytes(found[0].model) if found else None


def _repeated(grams: np.ndarray, n: int) -> int:
    """Words inside windows that occur twice or more."""
    _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
    at_window = np.flatnonzero(count[inverse] > 1)
    if not len(at_window):
        return 0
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, at_window, 1)
    np.add.at(cover, at_window + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def score(docs: DataFrame, model: bytes | None, keep: float = KEEP) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``probability`` and ``kept``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights = np.frombuffer(sent.value) if sent.value else None
        for batch in batches:
            for a, b, offsets, data in at.slices(batch.column("text")):
                rows = b - a
                starts, ends, first = at.word_bounds(offsets, data)
                n_words = np.diff(first)
                grams = at.shingle_hashes(at.word_hashes(data, starts, ends), WINDOW)
                point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                space = np.concatenate([[0], np.cumsum(at.SPACE[data])])
                symbol = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))])
                chars = np.diff(point[offsets]) - np.diff(space[offsets])
                symbols = np.diff(symbol[offsets])
                dups, repeats = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                for r in range(rows):
                    text = data[offsets[r]:offsets[r + 1]].tobytes()
                    lines = [x for x in text.split(b"\n") if x.strip()]
                    dups[r] = len(lines) - len(set(lines))
                    if n_words[r] > WINDOW:
                        repeats[r] = _repeated(grams[first[r]:first[r + 1] - WINDOW + 1], int(n_words[r]))
                if weights is None:
                    p = np.ones(rows)
                else:
                    z = np.full(rows, weights[-3])
                    for slot, row in _slots(data, offsets):
                        z += np.bincount(row, weights[slot], rows) / np.maximum(1, np.bincount(row, minlength=rows))
                    p = _sigmoid(weights[-2] * z + weights[-1])
                failed = (n_words < MIN_WORDS) | (100 * repeats > 20 * n_words)
                part = batch.slice(a, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("thash"), *(pa.array(x.astype(np.int64)) for x in (
                        n_words, chars, symbols, dups, repeats)), pa.array(failed), pa.array(p),
                     pa.array(~failed & (p >= keep))],
                    names=["doc_id", "thash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "probability", "kept"])

    return with_key(docs).mapInArrow(
        run, "doc_id long, thash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, probability double, kept boolean")
