"""Registry of the named queries exposed by ``__spark_entry__``.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that runs one
operator over whole driver tables; its DuckDB oracle (when SQL can express
it) is registered under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` as query ``name`` with an optional DuckDB oracle."""

    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco
