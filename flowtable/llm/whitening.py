"""Embedding whitening by shifted CholeskyQR.

The rows of the centred matrix A are orthogonalised without ever being
gathered: a pass over the data adds up the d x d Gram matrix of the rows (per
task, then per matrix row), the driver factors it, and the next pass sees the
rows times the inverse of that factor, through triangular solves. The first
factor takes a shift, so it exists however badly the columns are scaled; the
second and third repair the orthogonality that the shift costs. The composed
factor R has A = Q R with orthonormal Q, so the singular value decomposition
of R alone gives the components (right vectors) and their eigenvalues
(squared singular values over n). Only d x d matrices reach the driver.

Each entry c becomes the whole number x = floor(64 c) + 1000000 first; sums
and deviations are exact in whole numbers, and rows are centred before
anything is multiplied.

Defined cases: rows whose vector is null or holds a null or non-finite entry
are left out. The remaining vectors are whitened together if they have one
length; of several lengths, the most frequent takes part (the longer on a
tie) and the others are left out. Repeated rows count as often as they occur. Directions without variance (a
singular value below 1e-12 of the largest) have no component; without any
variance, and for an empty table, there are no rows. Entries beyond 2**46 in
size count as 2**46. A deviation too large for a long is null. Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000  # fixed values of the contract
COMPONENTS = 32
PASSES = 3
ROWS = 8192  # rows handled at once in a task
LIMIT = float(1 << 46)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector``: the rows whose vector has only finite entries."""
    out = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    return out.filter(F.col("vector").isNotNull() & F.forall(
        "vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The batch's x vectors, one row each."""
    flat = batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
    scaled = np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT)
    return scaled.astype(np.int64).reshape(-1, d) + OFFSET


def _chunks(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """n and the exact per-dimension sums, as Python integers."""
    def run(batches):
        n, total = 0, np.zeros(d, dtype=object)
        for batch in _chunks(batches):
            n += batch.num_rows
            total += _whole(batch, d).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([str(v) for v in total], pa.string())], names=["dim", "n", "total"])

    found = rows.mapInArrow(run, "dim int, n long, total string").groupBy("dim") \
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return (int(found[0].n) if found else 0), np.array([int(r.total) for r in sorted(found, key=lambda r: r.dim)], dtype=object)


def _gram(rows: DataFrame, d: int, k: int, project) -> np.ndarray:
    """The k x k sum of outer products of ``project(batch)`` over all rows,
    added up per task and then per matrix row."""
    def run(batches):
        total, seen = np.zeros((k, k)), False
        for batch in _chunks(batches):
            z = project(batch)
            total += z.T @ z
            seen = seen or batch.num_rows > 0
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((k, k))
    for r in found:
        out[r.i, r.j] = r.v
    return (out + out.T) / 2


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of ``gram`` plus the smallest shift, from ``shift`` up,
    for which it exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-16 * max(1e-300, np.trace(gram)))


class Whitening:
    """n, exact sums, the composed factor's components and eigenvalues."""

    def __init__(self, n, sums, components, eigenvalues, trace):
        self.n, self.sums, self.trace = n, sums, trace
        self.components, self.eigenvalues = components, eigenvalues

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(OFFSET + (int(s) - OFFSET * self.n) / self.n) for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, without loss: the whole part of S/n goes first."""
        whole = np.array([int(s) // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(int(s) % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))


def dimension(rows: DataFrame) -> int:
    """The most frequent vector length (the longer on a tie), 0 without rows."""
    found = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("c")) \
        .agg(F.max(F.struct("c", "d")).alias("top")).first()
    return int(found.top.d) if found and found.top else 0


def fit(rows: DataFrame, d: int, passes: int = PASSES) -> Whitening | None:
    """Components of the ``d``-dimensional rows, or None without variance."""
    if d == 0:
        return None
    n, sums = _sums(rows, d)
    if n == 0:
        return None
    model = Whitening(n, sums, None, None, 0.0)
    factors: list[np.ndarray] = []

    def project(batch: pa.RecordBatch) -> np.ndarray:
        z = model.centred(_whole(batch, d)).T
        for factor in factors:
            z = np.linalg.solve(factor.T, z)  # rows times the inverse of an upper factor
        return z.T

    unit = np.finfo(float).eps
    trace = 0.0
    for step in range(passes):
        gram = _gram(rows, d, d, project)
        if step == 0:
            trace = float(np.trace(gram))
            if not trace > 0:
                return None
        shift = 11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(gram, 2) if step == 0 else 0.0
        factors.append(_cholesky(gram, shift))
    # What the factors left undone (directions of no variance) is in the last
    # Gram matrix: its square root completes R.
    gram = _gram(rows, d, d, project)
    value, vector = np.linalg.eigh(gram)
    r = (vector * np.sqrt(np.clip(value, 0, None))) @ vector.T
    for factor in reversed(factors):
        r = r @ factor
    _, sigma, right = np.linalg.svd(r)
    keep = sigma > 1e-12 * sigma[0]
    model.components, model.eigenvalues = right[keep].T, sigma[keep] ** 2 / n
    model.trace = trace / n
    return model


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``."""
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(vectors, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    d = dimension(rows)
    rows = rows.filter(F.size("vector") == d)
    model = fit(rows, d)
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {schema}")
    k = min(components, len(model.eigenvalues))
    model.components, model.eigenvalues = model.components[:, :k], model.eigenvalues[:k]
    n, sums = model.n, [int(s) for s in model.sums]
    explained = model.eigenvalues / model.trace
    # Whitened rows have mean zero up to rounding: their Gram matrix over n is the covariance.
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    covariance = _gram(rows, d, k, lambda batch: sent.value.whiten(_whole(batch, d))) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    small = all(abs(s) < 1 << 62 for s in sums)

    def deviations(x: np.ndarray) -> list:
        wide = n * x.astype(object) - np.array(sums, dtype=object)
        if small and float(np.abs(x - sums[0] // n).max(initial=0)) * n * np.sqrt(d) < 2.0 ** 30:
            part = n * x - np.array(sums)
            return (part * part).sum(axis=1).tolist()
        found = (wide * wide).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in found]

    def run(batches):
        own = sent.value
        for batch in _chunks(batches):
            x = _whole(batch, d)
            m = len(x)
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            yield pa.RecordBatch.from_arrays(
                [pc.take(ids, pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                 pc.take(pa.array(deviations(x), pa.int64()), pa.array(np.repeat(np.arange(m), k))),
                 pa.array(own.whiten(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, {schema}")
