"""Parquet table access for the driver-generated tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def load_many(spark: SparkSession, sf_dir: str, names=TABLES, threads: int = 8) -> dict[str, DataFrame]:
    """Several tables at once: their file listings and footer reads (driver
    metadata work) run concurrently instead of one after another."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(names)))) as pool:
        frames = list(pool.map(lambda n: load(spark, sf_dir, n), names))
    return dict(zip(names, frames))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the tables as temp views (for ``run_query`` and SQL users)."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)
