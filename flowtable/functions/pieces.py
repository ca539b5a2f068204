"""Texts of many rows joined in order, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.session import stored

PIECE_ROWS = 4096  # a power of two: pieces never cross the borders of sorted partitions


def ordered_pieces(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], text: Column,
                   separator: str = "", size: int = PIECE_ROWS) -> DataFrame:
    """``key_cols``, ``piece``, ``n`` and ``text``: the texts of ``size`` neighbours
    in (keys, order, text) order joined by ``separator``. Pieces of a key, by
    ``piece``, give its whole text. The rows are range partitioned by a global
    sort, so a key with a very large share of the rows spreads over as many
    tasks as its rows fill. Any order type works; null texts are left out."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)]
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]
    rows = df.select(*keys, *order, text.alias("t"))
    # Numbered within sorted partitions; stored, so that the numbers stay.
    rows = stored(rows.sort(*rows.columns).select(*rows.columns[:len(keys)], "t", F.monotonically_increasing_id().alias("at")), "ordered")
    names = rows.columns[:len(keys)]
    parts = F.array_sort(F.collect_list(F.struct("at", "t")))
    pieces = rows.groupBy(*names, F.floor(F.col("at") / size).alias("piece")).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.transform(parts, lambda p: p["t"]), separator).alias("text"))
    return pieces.select(*[F.col(n).alias(c) for n, c in zip(names, key_cols)], "piece", "n", "text")
