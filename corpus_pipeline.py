"""A training-corpus pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
their columns; the last adds the token ids. Parameters are the operators'
production defaults. Other columns of the documents pass through all stages
unchanged, whatever their names; a column that the last stage adds gets
``_1`` behind its name where the documents have one of that name. An empty
table stays empty; documents without text fail the quality classifier or pass
it like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm import bpe, line_dedup, ngram_join, quality_gam, winnow
from flowtable.llm.common import fresh, materialize, whole_row, within, without
from flowtable.sources.tables import load


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.5 go."""
    model = quality_gam.train(docs, load(spark, sf_dir, "labels"))
    score, = fresh(docs, "quality_score")
    return quality_gam.score(docs, model, out=score).filter(F.col(score) >= 0.5).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; a document of which
    nothing is left goes. ``n_chars`` follows the text."""
    others = whole_row(docs, but=("doc_id", "text")).alias("row")
    cut = line_dedup.dedup_lines(docs.select(docs["doc_id"], docs["text"], others))
    cut = cut.filter("not (n_removed > 0 and text = '')")
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"),
           "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row").getField("n_chars"))}
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles,
    similarity 0.8). Of rows with one doc_id and text, that whose columns come
    first as JSON text stays."""
    rest = without(docs, ngram_join.near_duplicates(docs))
    ids = materialize(docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("thash"))
                      .groupBy("doc_id", "thash").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "repeated-rows")
    if ids.isEmpty():
        return rest
    again = within(rest, ids)
    row = whole_row(again)
    one = again.select(again["doc_id"].alias("k1"), again["text"].alias("k2"), row.alias("row"), F.to_json(row).alias("json")) \
        .groupBy("k1", "k2").agg(F.min_by("row", "json").alias("row"))
    return without(rest, ids).unionAll(one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    found = winnow.contamination(docs, load(spark, sf_dir, "benchmark"))
    return without(docs, materialize(found.filter(winnow.contaminated()).select("doc_id", "thash").distinct(), "contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether the ids decode to the text."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids, n_tokens, round_trip, decoded = fresh(docs, "ids", "n_tokens", "round_trip", "decoded")
    out = bpe.decode(bpe.encode(docs, path, pattern, ids=ids), path, pattern, ids=ids, out=decoded)
    same = F.col(decoded) == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], ids, F.size(ids).cast("long").alias(n_tokens),
                      same.alias(round_trip))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminate), ("byte-level BPE", tokenize)]

#: SQL cannot express the classifier and the tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
