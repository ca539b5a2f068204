"""Object sync: incremental extract, changed / deleted ids, row lookup, user queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.operators.records import JSON_OPTIONS
from flowtable.session import small_side


def typed_literal(df: DataFrame, col: str, value) -> Column:
    """``value`` as a literal of ``col``'s own type, so the comparison stays a
    plain column-vs-literal predicate that reaches the parquet scan."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        if isinstance(value, dt.datetime):
            value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.to_timestamp_ntz(F.lit(str(value)))
    if isinstance(dtype, T.TimestampType):
        if isinstance(value, dt.datetime):
            return F.lit(value)
        return F.to_timestamp(F.lit(str(value)))
    return F.lit(value).cast(dtype)


def incremental_extract(df: DataFrame, fields: Sequence[str], ts_col: str, last_sync, ordered: bool = True) -> DataFrame:
    """Rows modified strictly after ``last_sync``: the listed fields (plus the
    timestamp), ascending by timestamp. Filter and projection reach the scan."""
    cols = list(fields) + ([ts_col] if ts_col not in fields else [])
    out = df.where(F.col(ts_col) > typed_literal(df, ts_col, last_sync)).select(*cols)
    return out.orderBy(F.col(ts_col).asc()) if ordered else out


def changed_ids(df: DataFrame, id_col: str, ts_col: str, start, end) -> DataFrame:
    """Ids with a change in ``[start, end)``: id, last change time, number of changes.
    Partial aggregation runs before the shuffle, so a hot id costs one row per task."""
    span = (F.col(ts_col) >= typed_literal(df, ts_col, start)) & (F.col(ts_col) < typed_literal(df, ts_col, end))
    return (df.where(span).groupBy(id_col)
            .agg(F.max(ts_col).alias("last_modified"), F.count(F.lit(1)).alias("n_changes")))


def deleted_ids(df: DataFrame, id_col: str, ts_col: str, deleted: Column | str, start, end) -> DataFrame:
    """Ids deleted in ``[start, end)`` according to a deletion flag column or predicate."""
    flag = F.expr(deleted) if isinstance(deleted, str) else deleted
    span = (F.col(ts_col) >= typed_literal(df, ts_col, start)) & (F.col(ts_col) < typed_literal(df, ts_col, end))
    return df.where(flag & span).groupBy(id_col).agg(F.max(ts_col).alias("deleted_at"))


def deleted_between(old_df: DataFrame, new_df: DataFrame, id_col: str) -> DataFrame:
    """Snapshot form: ids present in ``old_df`` and absent from ``new_df``."""
    old_ids = old_df.select(id_col).distinct()
    return old_ids.join(new_df.select(id_col), id_col, "left_anti")


def row_lookup(df: DataFrame, id_col: str, ids_df: DataFrame, ids_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids_df`` (semi join; the id side is
    broadcast only when its size is proven small)."""
    raw = ids_df.select(F.col(ids_col or id_col).alias(id_col))
    return df.join(small_side(raw.distinct(), check=raw), id_col, "left_semi")


def run_query(spark: SparkSession, sql: str, args: Mapping | None = None,
              views: Mapping[str, DataFrame] | None = None, as_json: bool = False) -> DataFrame:
    """Run a user's SQL text with named parameters over the given views;
    ``as_json`` turns each result row into JSON content."""
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    out = spark.sql(sql, args=dict(args) if args else None)
    if as_json:
        out = out.select(F.to_json(F.struct(*[F.col(c) for c in out.columns]), JSON_OPTIONS).alias("content"))
    return out
