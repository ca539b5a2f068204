"""Connected components of an edge table, by alternating large and small star
steps: every step is an aggregated minimum per node and a join, so a node with
very many neighbours never sits in one task. Each round is written to the
shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtable.llm.common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """``pairs`` (u, v): link u's (larger or not larger) neighbours to the
    smallest of u and all its neighbours."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("mu"), F.least("u", "m").alias("m"))
    linked = pairs.join(low, pairs["u"] == low["mu"])
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionAll(low.select(F.col("mu").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): root is the smallest node that
    can be reached. Nodes without edges do not appear."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    digest = None
    while True:
        step = _star(_both_ways(now), large=True)
        step = _star(step.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), large=False)
        now = materialize(step, "components")
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == digest or new[0] == 0:
            break
        digest = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
