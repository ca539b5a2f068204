"""Bounded, deterministic samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, where=None) -> DataFrame:
    """``doc_id, text, y`` of at most ``limit`` labelled rows, chosen by a hash
    of the id (the same at every run; one label per id, the smaller on
    conflict; null ids and labels are left out). ``limit`` bounds the side
    that is broadcast; the texts are read whole."""
    chosen = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("y")) \
        .filter("doc_id is not null and y in (0, 1)")
    if where is not None:
        chosen = chosen.filter(where)
    chosen = chosen.groupBy("doc_id").agg(F.min("y").alias("y")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
