"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.session import shared_dir

# A side is broadcast only when its measured in-memory size is below this.
BROADCAST_MAX_BYTES = 32 << 20


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder (kept as the URI it names)."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later
    steps survive lost executors and never recompute it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, row_bytes: int | None = None) -> DataFrame:
    """Broadcast hint for a *materialised* table whose in-memory size is proven
    to be below ``BROADCAST_MAX_BYTES``; otherwise the plain table, so the join
    shuffles. Fixed-width rows give ``row_bytes``; else every row is measured
    through its JSON length."""
    if row_bytes is None:
        size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 64)
    else:
        size = F.count(F.lit(1)) * row_bytes
    total = df.agg(size.alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= BROADCAST_MAX_BYTES else df


def with_key(docs: DataFrame) -> DataFrame:
    """``doc_id, text, thash``: the columns an operator reads, with null text
    as the empty string. (doc_id, thash) tells rows apart when ids repeat;
    identical rows share it and always get the same result. Other columns,
    whatever their names, are not read."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("thash"))


def same_key(a: DataFrame, b: DataFrame):
    """Null-safe equality of (doc_id, thash) between two tables."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["thash"] == b["thash"])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have in any case of
    letters: a name that is taken gets ``_1``, ``_2``, ... behind it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        free, n = name, 0
        while free.lower() in taken:
            n += 1
            free = f"{name}_{n}"
        taken.add(free.lower())
        out.append(free)
    return out


def whole_row(df: DataFrame, but: tuple[str, ...] = ()):
    """The columns of ``df`` (without those in ``but``) as one struct, whatever
    their names."""
    return F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns if c not in but])


def _keyed_join(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = maybe_broadcast(keys.select(F.col("doc_id").alias("gone_id"), F.col("thash").alias("gone_hash")), row_bytes=48)
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.join(keys, docs["doc_id"].cast("long").eqNullSafe(keys["gone_id"])
                     & (F.xxhash64(text) == keys["gone_hash"]), how)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, thash) is among the
    materialised ``keys``; broadcast only if those are proven small."""
    return _keyed_join(docs, keys, "left_anti")


def within(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Only the rows whose (doc_id, thash) is among the ``keys``."""
    return _keyed_join(docs, keys, "left_semi")


ARROW_ROWS = 256  # rows of an output batch


def with_arrow_column(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with one more column ``name`` (in place of one of that name),
    computed from column ``source`` by ``make(array) -> array`` in small Arrow
    batches. All other columns pass through."""
    kept = [(i, f) for i, f in enumerate(df.schema.fields) if f.name != name]
    names = [f"c{i}" for i, _ in kept] + ["made"]
    schema = T.StructType([T.StructField(n, f.dataType) for n, (_, f) in zip(names, kept)] + [T.StructField("made", kind)])
    at = df.columns.index(source)

    def run(batches):
        for whole in batches:
            for row in range(0, whole.num_rows, ARROW_ROWS):
                batch = whole.slice(row, ARROW_ROWS)
                columns = [batch.column(i) for i, _ in kept]
                yield pa.RecordBatch.from_arrays([*columns, make(batch.column(at))], names=names)
            pa.default_memory_pool().release_unused()

    # Plain names inside: the call cannot resolve names with dots.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, schema).toDF(*[f.name for _, f in kept], name)
