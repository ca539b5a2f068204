"""Approximate nearest neighbours by collision counting.

All vectors are scaled to length one, so the largest cosine is the smallest
distance. The table is dealt into shards of about ``SHARD_ROWS`` vectors. A
shard's index is one sorted array per random projection: its vectors in the
order of that single projection. A query opens a window around its own
projected value in each array; rings are added to the windows as their half
width grows step by step (virtual rehashing: the wider bucket is centred on
the query, nothing is hashed again). A vector's collisions are the windows
that hold it. Vectors with at least ``threshold`` collisions are verified: the
exact cosine, on the original vectors, in double precision.

A projected difference is normal with the distance as its deviation, so a
vector no farther than half the width w falls into each window with a chance
of p = P(|N(0, 1)| <= 1) or more. The threshold is the number of collisions
that a binomial count over all projections reaches with a chance of at least
``1 - MISS``, and the windows of a shard stop growing only once they are as
wide as the ``k``-th nearest vector verified there is far. So each of the true
neighbours is found with a chance of at least ``1 - MISS`` whatever the data;
there is no cap on windows, candidates or partners.

Every vector is indexed. The queries (a stated fraction of the rows) meet the
shards in blocks: a (shard, query block) cell is one group, and both sides of
a cell have a bounded size. The best ``k`` of each cell are merged per query.

Defined cases: vectors that are null, zero, empty or hold null or non-finite
entries take no part, nor do rows without an id; rows repeated whole count
once; an id with several different vectors is several queries and several
candidates; vectors meet only those of their own length; with fewer than
``k`` candidates all are returned; ties go to the smaller id; a query without
candidates, and an empty table, give no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtable.llm.common import materialize

SHARD_ROWS = 16_384
BLOCK_ROWS = 16_384  # queries in a block
PROJECTIONS = 64
MISS = 0.08
GROWTH = 1.2  # factor of the window's width from step to step
START = 0.5  # least first half width


@functools.lru_cache(maxsize=4)
def projections(d: int, m: int = PROJECTIONS) -> np.ndarray:
    """m random directions, d x m: orthogonal within blocks of d, each with the
    length of a normal vector, so that every projection alone is normal."""
    rng = np.random.RandomState(20111)
    blocks = []
    while sum(b.shape[1] for b in blocks) < m:
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        blocks.append(q * np.sqrt(rng.chisquare(d, size=d)))
    return np.concatenate(blocks, axis=1)[:, :m]


@functools.lru_cache(maxsize=4)
def threshold(m: int = PROJECTIONS, miss: float = MISS) -> int:
    """The largest count that Binomial(m, p) reaches with a chance of 1 - miss."""
    p = math.erf(1 / math.sqrt(2))
    below = 0.0
    for count in range(m + 1):
        below += math.comb(m, count) * p ** count * (1 - p) ** (m - count)
        if below > miss:
            return count
    return m


class Index:
    """Sorted arrays of one shard, laid end to end."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.directions = projections(vectors.shape[1], m)
        values = ((vectors / self.norms[:, None]) @ self.directions).T
        order = np.argsort(values, axis=1, kind="stable")
        self.order = order.astype(np.int32).ravel()
        # Every array has a range of numbers of its own, so that one sorted
        # look-up finds a place in each.
        self.apart = np.arange(m) * (4 + 2 * np.abs(values).max())
        self.values = (np.take_along_axis(values, order, axis=1) + self.apart[:, None]).ravel()
        self.edges = np.arange(m + 1) * len(ids)
        self.half = START

    def cosines(self, rows: np.ndarray, vector: np.ndarray, norm: float) -> np.ndarray:
        """Row by row, so that equal vectors get equal scores."""
        return (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * norm)

    def search(self, vector: np.ndarray, own: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, cosines) of the k best verified vectors; ``own`` is
        the query's row number here, or -1."""
        n = len(self.ids)
        norm = math.sqrt(float((vector * vector).sum()))
        centre = (vector / norm) @ self.directions + self.apart
        place = lambda at, side: np.clip(np.searchsorted(self.values, at, side), self.edges[:-1], self.edges[1:])
        lo = hi = place(centre, "left")
        counts = np.zeros(n, dtype=np.int64)
        verified = np.zeros(n, dtype=bool)
        if own >= 0:
            verified[own] = True
        rows, scores, half, order = np.zeros(0, np.int64), np.zeros(0), self.half, self.order
        while True:
            low, high = place(centre - half, "left"), place(centre + half, "right")
            ends = zip([*low.tolist(), *hi.tolist()], [*lo.tolist(), *high.tolist()])
            counts += np.bincount(np.concatenate([order[a:b] for a, b in ends]), minlength=n)
            lo, hi = low, high
            fresh = np.flatnonzero((counts >= least) & ~verified)
            if len(fresh):
                verified[fresh] = True
                rows = np.concatenate([rows, fresh])
                scores = np.concatenate([scores, self.cosines(fresh, vector, norm)])
                best = np.lexsort((self.ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            if (lo == self.edges[:-1]).all() and (hi == self.edges[1:]).all():
                return rows, scores
            if len(rows) == k:
                far = math.sqrt(max(0.0, 2 - 2 * scores[-1]))
                if half >= far:
                    # The next query of this shard starts a little below.
                    self.half = max(START, 0.9 * far)
                    return rows, scores
                half = min(max(half * GROWTH, half + 1e-9), far)
            else:
                half *= GROWTH


def _unit(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector, d`` of the rows that take part, each once."""
    out = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("vector"))
    out = out.filter("vec_id is not null and vector is not null and size(vector) > 0").filter(F.forall(
        "vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    out = out.filter(F.exists("vector", lambda c: c != 0.0))
    return out.withColumn("d", F.size("vector")).dropDuplicates(["vec_id", "vector"])


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks()
    flat = (flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])).to_numpy()
    matrix = flat.reshape(len(ids), -1)
    # A power of two keeps squares in range and changes no cosine.
    top = np.abs(matrix).max(axis=1, keepdims=True)
    return ids, np.ldexp(matrix, -np.frexp(top)[1])


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row
    where ``queries`` (a condition on ``vec_id``) holds."""
    rows = materialize(_unit(vectors, id_col, vector_col), "vectors")
    total, asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(queries.cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-total // SHARD_ROWS)), max(1, -(-asked // BLOCK_ROWS))
    key = F.xxhash64("vec_id", "vector")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("d", F.pmod(key, F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), "vec_id", "vector")
    asks = rows.filter(queries).select("d", every(shards).alias("shard"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"),
                                       F.xxhash64(key, F.lit(1)).alias("ask"), "vec_id", "vector")
    names = ["ask", "query_id", "vec_id", "score"]

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            ids, matrix = _matrix(left)
            index, least = Index(ids, matrix), threshold()
            wanted, vectors_ = _matrix(right)
            for ask, query, vector in zip(right.column("ask").to_numpy(), wanted, vectors_):
                same = np.flatnonzero(ids == query)
                own = next((int(i) for i in same if np.array_equal(matrix[i], vector)), -1)
                found, scores = index.search(vector, own, k, least)
                out[0] += [ask] * len(found)
                out[1] += [query] * len(found)
                out[2] += ids[found].tolist()
                out[3] += scores.tolist()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    cells = data.groupBy("d", "shard", "block").cogroup(asks.groupBy("d", "shard", "block")) \
        .applyInArrow(cell, "ask long, query_id long, vec_id long, score double")
    # At most k rows a cell; a partial limit keeps k of each query in a task before the shuffle.
    order = Window.partitionBy("query_id", "ask").orderBy(F.col("score").desc(), "vec_id")
    return cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
