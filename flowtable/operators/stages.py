"""Pluggable Python stages: a user's batch function or a model with a
load-once set-up, run with ``mapInPandas`` (pieces of Arrow batches, one loader
per task). A failing row routes ``failure``; it never fails the task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowtable.session import spread

ROUTE_FIELDS = [T.StructField("exit_code", T.IntegerType()), T.StructField("route", T.StringType()),
                T.StructField("error", T.StringType())]

# Rows of a function's or a model's call: what it makes of them on the way is
# several times their size, and an Arrow batch holds up to 10,000 rows.
PIECE_ROWS = 1024


def _schema(keep: Sequence[T.StructField], out_schema: T.StructType) -> T.StructType:
    return T.StructType(list(keep) + list(out_schema.fields) + ROUTE_FIELDS)


def _run(fn, pdf: pd.DataFrame, out_names: list[str], no_result: bool) -> list[pd.DataFrame]:
    """``fn`` over the batch; if it fails, over its two halves, down to the
    rows that fail alone. A few bad rows cost a few more calls, not one a row."""
    if not len(pdf):
        return []
    try:
        res = fn(pdf)
        if len(res) != len(pdf):
            raise ValueError(f"stage returned {len(res)} rows for {len(pdf)}")
        res = res[out_names].set_axis(pdf.index)
        empty = res.isna().all(axis=1) if no_result else pd.Series(False, index=pdf.index)
        return [res.assign(exit_code=0, route=["no results" if e else "success" for e in empty], error=None)]
    except Exception as exc:  # a bad row becomes a failure row, its message whole
        if len(pdf) == 1:
            row = pd.DataFrame([[None] * len(out_names)], columns=out_names, index=pdf.index, dtype=object)
            return [row.assign(exit_code=1, route="failure", error=f"{type(exc).__name__}: {exc}")]
        half = len(pdf) // 2
        return _run(fn, pdf.iloc[:half], out_names, no_result) + _run(fn, pdf.iloc[half:], out_names, no_result)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in pieces of at most ``PIECE_ROWS`` rows. A batch is let go
    before the next one is read, and Arrow's memory goes back."""
    for pdf in batches:
        for a in range(0, len(pdf), PIECE_ROWS):
            yield pdf.iloc[a:a + PIECE_ROWS].reset_index(drop=True)
        del pdf
        pa.default_memory_pool().release_unused()


def _apply(fn, pdf: pd.DataFrame, keep: list[str], out_names: list[str], no_result: bool) -> pd.DataFrame:
    parts = _run(fn, pdf, out_names, no_result)
    if not parts:
        return pd.DataFrame(columns=[*keep, *out_names, *(f.name for f in ROUTE_FIELDS)])
    # Object columns of failed rows must not change the type of the others.
    res = pd.concat([p.astype(object) for p in parts]) if len(parts) > 1 else parts[0]
    return pd.concat([pdf[keep].reset_index(drop=True), res.reset_index(drop=True)], axis=1)


def python_stage(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], out_schema: T.StructType | str,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Run ``fn(batch) -> batch`` (row-aligned) over batches of at most
    ``PIECE_ROWS`` rows.

    Output: ``keep`` columns, ``out_schema`` columns, exit_code, route, error.
    A batch that raises is halved until the failing rows stand alone; they get
    exit code 1, route ``failure`` and the whole error text.
    """
    out_schema = T._parse_datatype_string(out_schema) if isinstance(out_schema, str) else out_schema
    keep = list(keep)
    keep_fields = [df.schema[c] for c in keep]
    out_names = out_schema.fieldNames()

    def run(batches):
        for pdf in _pieces(batches):
            yield _apply(fn, pdf, keep, out_names, no_result=False)

    return spread(df, heavy=True).mapInPandas(run, _schema(keep_fields, out_schema))


def model_batch_job(df: DataFrame, loader: Callable[[], object],
                    predict: Callable[[object, pd.DataFrame], pd.DataFrame],
                    out_schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Per-record model call with load-once set-up.

    ``loader()`` runs once per task (in the iterator's prologue), then
    ``predict(model, batch)`` per batch of at most ``PIECE_ROWS`` rows
    (row-aligned). Rows whose outputs are all null route ``no results``; rows that raise route ``failure``.
    """
    out_schema = T._parse_datatype_string(out_schema) if isinstance(out_schema, str) else out_schema
    keep = list(keep)
    keep_fields = [df.schema[c] for c in keep]
    out_names = out_schema.fieldNames()

    def run(batches):
        model = loader()
        fn = lambda pdf: predict(model, pdf)
        for pdf in _pieces(batches):
            yield _apply(fn, pdf, keep, out_names, no_result=True)

    return spread(df, heavy=True).mapInPandas(run, _schema(keep_fields, out_schema))
