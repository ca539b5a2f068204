"""Record model helpers: named routes, per-route outputs and content sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.functions.pieces import PIECE_ROWS, ordered_pieces
from flowtable.session import stored


def _as_col(pred: Column | str) -> Column:
    return F.expr(pred) if isinstance(pred, str) else pred


def route_split(df: DataFrame, routes: Sequence[tuple[str, Column | str]], default: str = "unmatched",
                route_col: str = "route") -> DataFrame:
    """Adds ``route_col``: the name of the first route whose predicate holds,
    else ``default``. Routes are evaluated in order (one route per record)."""
    if not routes:
        return df.withColumn(route_col, F.lit(default))
    expr = None
    for name, pred in routes:
        cond = _as_col(pred)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(route_col, expr.otherwise(F.lit(default)))


def outputs(df: DataFrame, names: Sequence[str], route_col: str = "route",
            keep_original: bool = True) -> dict[str, DataFrame]:
    """One DataFrame per named route (a filter each); ``original`` is the
    input itself. Persist ``df`` first when several outputs are consumed."""
    out = {name: df.where(F.col(route_col) == F.lit(name)) for name in names}
    if keep_original:
        out["original"] = df.drop(route_col)
    return out


# Times keep their microseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def as_json_content(df: DataFrame, per: str = "row", key_cols: Sequence[str] = (),
                    order_cols: Sequence[str] = (), content_col: str = "content", piece_rows: int | None = None) -> DataFrame:
    """Rows as JSON text content.

    * ``per='row'``: one JSON object per row (no shuffle).
    * ``per='group'``: one JSON array per key, elements sorted by ``order_cols``
      (partial aggregation before the shuffle). With ``piece_rows`` (a power of
      two) a key's array comes in pieces of at most that many elements, with
      column ``part``: the contents of a key's parts, joined in order, are the
      array. So a key may hold any share of the rows.
    * ``per='table'``: one JSON array for the whole result, always in such
      pieces (of 4096 rows if ``piece_rows`` does not say otherwise).
    """
    if per == "row":
        return df.select(*key_cols, F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias(content_col))
    body_cols = [c for c in df.columns if c not in key_cols]
    ordered = list(order_cols) + [c for c in body_cols if c not in order_cols]
    elem = F.struct(*[F.col(c) for c in ordered])
    if per not in ("group", "table"):
        raise ValueError("per must be 'row', 'group' or 'table'")
    if per == "group" and not key_cols:
        raise ValueError("per='group' needs key_cols")
    if per == "group" and piece_rows is None:
        return df.groupBy(*key_cols).agg(F.to_json(F.array_sort(F.collect_list(elem)), JSON_OPTIONS).alias(content_col))
    keys = list(key_cols) if per == "group" else []
    pieces = ordered_pieces(df, keys, list(order_cols), F.to_json(elem, JSON_OPTIONS), ",", piece_rows or PIECE_ROWS)
    pieces = stored(pieces, "json-pieces")
    if not keys and pieces.isEmpty():
        return df.sparkSession.createDataFrame([(0, "[]")], f"part long, {content_col} string")
    if keys:
        ends = pieces.groupBy(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)]).agg(
            F.min("piece").alias("_first"), F.max("piece").alias("_last"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & pieces[k].eqNullSafe(ends[f"_e{i}"])
        both = pieces.join(ends, same)
    else:
        both = pieces.withColumn("_first", pieces.agg(F.min("piece")).scalar()).withColumn("_last", pieces.agg(F.max("piece")).scalar())
    text = F.concat(F.when(F.col("piece") == F.col("_first"), "[").otherwise(""), F.col("text"),
                    F.when(F.col("piece") == F.col("_last"), "]").otherwise(","))
    return both.select(*keys, F.col("piece").alias("part"), text.alias(content_col))
