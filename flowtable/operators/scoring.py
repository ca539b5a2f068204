"""Scoring and transcript operators: best label, top-k annotations,
lexicon sentiment, utterances and transcript assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtable.functions.pieces import ordered_pieces
from flowtable.functions.text import word_count
from flowtable.session import small_side, spread

NO_DETECTIONS = "no detections"
NO_RESULTS = "no results"


def normalize(values: Column, mean: float = 0.0, scale: float = 1.0) -> Column:
    """``(v - mean) / scale`` over an array, in double precision."""
    return F.transform(values, lambda v: (v.cast("double") - F.lit(float(mean))) / F.lit(float(scale)))


def best_index(values: Column) -> Column:
    """1-based index of the largest value, first index on ties. A NaN never
    wins unless it is the first element (then nothing beats it)."""
    clean = F.transform(values, lambda v: F.when(F.isnan(v), F.lit(None)).otherwise(v))
    first_nan = F.isnan(F.element_at(values, 1))
    return (F.when(F.size(values) == 0, F.lit(None))
            .when(first_nan, F.lit(1))
            .otherwise(F.array_position(clean, F.array_max(clean)).cast("int")))


def label_top1(df: DataFrame, scores_col: str, labels: Sequence[str] | Column, mean: float = 0.0,
               scale: float = 1.0, digits: int = 4) -> DataFrame:
    """Adds ``label_index`` (0-based), ``label_name`` and ``label_score``
    (score × 100, double precision, rounded to ``digits``)."""
    scores = F.col(scores_col)
    if mean != 0.0 or scale != 1.0:
        scores = normalize(scores, mean, scale)
    idx = best_index(scores)
    names = labels if isinstance(labels, Column) else F.array(*[F.lit(x) for x in labels])
    # guard the lookups: a null index must not reach element_at (generated code
    # would read it as a default integer)
    has = F.col("_idx").isNotNull()
    score = F.round(F.element_at(scores, F.col("_idx")).cast("double") * F.lit(100.0), digits)
    return (df.withColumn("_idx", idx)
            .withColumn("label_index", F.col("_idx") - 1)
            .withColumn("label_name", F.when(has, F.element_at(names, F.col("_idx"))))
            .withColumn("label_score", F.when(has, score)).drop("_idx"))


def top_k_annotations(df: DataFrame, key_cols: Sequence[str], feature_col: str, score_col: str,
                      features: Sequence[str] | None = None, k: int = 10,
                      tie_cols: Sequence[str] = (), keys_df: DataFrame | None = None) -> DataFrame:
    """At most ``k`` best-scored annotations per key and enabled feature.

    ``row_number() <= k`` gets a partial group limit before the shuffle, so a
    hot key ships at most ``k`` rows per task. With ``keys_df``, keys without
    any annotation come out once with route ``no detections``: the keys travel
    as marked rows through the same window, and a mark stays where its key has
    nothing else.
    """
    src = df if features is None else df.where(F.col(feature_col).isin(list(features)))
    src = src.withColumn("_mark", F.lit(False))
    if keys_df is not None:
        marks = [F.col(f.name) if f.name in key_cols else F.lit(f.name == "_mark").alias(f.name) if f.name == "_mark"
                 else F.lit(None).cast(f.dataType).alias(f.name) for f in src.schema.fields]
        src = src.unionAll(keys_df.select(*marks))
    w = Window.partitionBy(*key_cols, feature_col, "_mark").orderBy(F.col(score_col).desc(), *[F.col(c) for c in tie_cols])
    top = src.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    if keys_df is None:
        return top.drop("_mark").withColumn("route", F.lit("success"))
    # At most k rows a feature and k marks a key are left.
    top = top.where(~F.col("_mark") | (F.col("rank") == 1))
    found = F.max(~F.col("_mark")).over(Window.partitionBy(*key_cols))
    top = top.withColumn("_found", found).where(~F.col("_mark") | ~F.col("_found"))
    return top.withColumn("rank", F.when(~F.col("_mark"), F.col("rank"))) \
        .withColumn("route", F.when(F.col("_mark"), F.lit(NO_DETECTIONS)).otherwise(F.lit("success"))).drop("_mark", "_found")


def words(text: Column) -> Column:
    """Lower-cased words of letters of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


# Lexicons up to this size are inlined as a map literal and summed inside each row.
INLINE_LEXICON_MAX = 256


def _sentiment_result(key_col: str, s: Column, m: Column, n: Column, digits: int) -> list[Column]:
    found = n > 0
    return [F.col(key_col),
            F.when(found, F.coalesce(F.round(s / F.nullif(m, F.lit(0.0)), digits), F.lit(0.0))).alias("score"),
            F.when(found, F.round(m, digits)).alias("magnitude"),
            n.alias("n_hits"),
            F.when(found, F.lit("success")).otherwise(F.lit(NO_RESULTS)).alias("route")]


def sentiment(df: DataFrame, key_col: str, text_col: str, lexicon_df: DataFrame, token_col: str = "token",
              weight_col: str = "weight", digits: int = 6) -> DataFrame:
    """Per text: ``magnitude`` = Σ|weight|, ``score`` = Σweight / magnitude of
    its lexicon tokens (score 0 when all weights met are 0); texts without any
    lexicon token route ``no results``. A token's weights add up first, so both
    plans below count a hit once. Rows with one id stay apart.

    A lexicon proven to hold at most ``INLINE_LEXICON_MAX`` entries becomes a
    map literal and the weights are folded inside each row: no explode, no
    shuffle. A larger lexicon is joined to the exploded tokens (broadcast when
    its size is proven small) and summed with a partial aggregate, so each task
    ships one row per text.
    """
    lex = lexicon_df.select(F.col(token_col).alias("_tok"), F.col(weight_col).cast("double").alias("_w")) \
        .where("_tok is not null and _w is not null").groupBy("_tok").agg(F.sum("_w").alias("_w"))
    small = lex.limit(INLINE_LEXICON_MAX + 1).collect()  # a bounded parameter table, not data
    if len(small) <= INLINE_LEXICON_MAX:
        weights = dict(map(tuple, small))
        if not weights:
            lit_map = F.create_map().cast("map<string,double>")
        else:
            lit_map = F.create_map(*[x for tok, w in weights.items() for x in (F.lit(tok), F.lit(float(w)))])
        init = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("m"), F.lit(0).cast("long").alias("n"))

        def step(acc, word):
            w = lit_map[word]
            return F.when(w.isNull(), acc).otherwise(
                F.struct((acc["s"] + w).alias("s"), (acc["m"] + F.abs(w)).alias("m"), (acc["n"] + 1).alias("n")))

        folded = spread(df, heavy=True).select(F.col(key_col), F.aggregate(words(F.col(text_col)), init, step).alias("_f"))
        return folded.select(*_sentiment_result(key_col, F.col("_f.s"), F.col("_f.m"),
                                                F.coalesce(F.col("_f.n"), F.lit(0).cast("long")), digits))
    rows = df.withColumn("_row", F.monotonically_increasing_id())  # before the explode: one number per text
    exploded = rows.select(F.col(key_col), "_row", F.explode_outer(words(F.col(text_col))).alias("_tok"))
    hits = exploded.join(small_side(lex), "_tok", "left")
    agg = hits.groupBy(key_col, "_row").agg(F.sum("_w").alias("_s"), F.sum(F.abs("_w")).alias("_m"),
                                    F.count("_w").alias("n_hits"))
    return agg.select(*_sentiment_result(key_col, F.col("_s"), F.col("_m"), F.col("n_hits"), digits))


def utterances(df: DataFrame, key_col: str, order_col: str, text_col: str, confidence_col: str | None = None) -> DataFrame:
    """One result row per recognised utterance: transcript, bytes, words, and
    its confidence where the input has one; an empty or missing text routes
    ``no results``."""
    text = F.col(text_col)
    empty = F.coalesce(word_count(text), F.lit(0)) == 0
    return df.select(
        key_col, order_col, text.alias("transcript"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(word_count(text), F.lit(0)).cast("long").alias("n_words"),
        F.when(empty, F.lit(NO_RESULTS)).otherwise(F.lit("success")).alias("route"),
        *([F.col(confidence_col).cast("double").alias("confidence")] if confidence_col else []))


def _ordered_join(order: Column, text: Column) -> Column:
    """Texts sorted by order, each followed by one space (an aggregate expression)."""
    parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.coalesce(p["t"], F.lit("")), F.lit(" "))), "")


def assemble_transcript(df: DataFrame, key_col: str, order_col: str, text_col: str,
                        out_col: str = "transcript", bucket_size: int | None = 4096) -> DataFrame:
    """Texts of a key in order, each followed by one space (trailing space kept).

    With an integral order column the work is split in two levels: texts are
    first joined within buckets of ``bucket_size`` consecutive order values
    (so no group collects more than a bucket of turns), then the per-key merge
    concatenates the bucket strings in order. Both levels combine map-side
    before their shuffle. Any other order type is sorted globally instead
    (``ordered_pieces``), which needs no bounds on the order values.
    """
    order, text = F.col(order_col), F.col(text_col)
    integral = df.schema[order_col].dataType.typeName() in ("long", "integer", "short", "byte")
    if not bucket_size or not integral:
        turn = F.concat(F.coalesce(text, F.lit("")), F.lit(" "))
        pieces = ordered_pieces(df, [key_col], [order_col], turn)
        whole = F.array_sort(F.collect_list(F.struct("piece", "text")))
        return pieces.groupBy(key_col).agg(F.array_join(F.transform(whole, lambda p: p["text"]), "").alias(out_col),
                                           F.sum("n").alias("n_parts"))
    buckets = df.groupBy(key_col, F.floor(order / F.lit(int(bucket_size))).alias("_b")).agg(
        _ordered_join(order, text).alias("_part"), F.count(F.lit(1)).alias("_n"))
    merged = F.array_sort(F.collect_list(F.struct(F.col("_b").alias("b"), F.col("_part").alias("p"))))
    return buckets.groupBy(key_col).agg(
        F.array_join(F.transform(merged, lambda x: x["p"]), "").alias(out_col),
        F.sum("_n").alias("n_parts"))
