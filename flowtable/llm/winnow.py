"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides keep, of every window of w consecutive k-gram hashes, the smallest.
A span of w + k - 1 common words therefore shares a kept hash, which is the
length of an item's window (13 words, or the whole item if it is shorter), so
no shared window is missed. Kept hashes of documents and items are joined; for
the (document, item) pairs that meet, every common k-gram gives a diagonal,
and the words are compared along it: runs of equal words of the window's
length or more are the hits.

The join key is built from fully lower-cased words (cheap and at most too
generous); the comparison uses A-Z folding only, so results are exact.

Defined cases: null or empty texts have no words and no hits; items without
words or with a null item_id match nothing; repeated item_ids count once, with
the windows of all their texts; repeated document rows get the same result;
documents of any length are read whole; empty tables on either side give no
hits; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.llm.common import materialize, maybe_broadcast, same_key, with_key

WINDOW = 13
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _cut(text: Column) -> Column:
    return F.filter(F.split(text, GAPS, -1), lambda w: w != "")


def exact_words(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else changed."""
    return _cut(F.translate(text, UPPER, LOWER))


def folded_words(text: Column) -> Column:
    """As many words, fully lower-cased (the final sigma rule is avoided, so
    words that are equal under A-Z folding are equal here wherever they stand)."""
    return _cut(F.lower(F.replace(text, F.lit("Σ"), F.lit("σ"))))


def _grams(words: Column, k: int) -> Column:
    """Hashes of the k-word windows; empty when there are fewer words."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.xxhash64(F.slice(words, i, k)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _kept(grams: Column, w: int) -> Column:
    """The distinct smallest hashes of all windows of w k-grams."""
    if w == 1:
        return F.array_distinct(grams)
    return F.when(F.size(grams) >= w, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(grams) - w + 1), lambda i: F.array_min(F.slice(grams, i, w))))) \
        .otherwise(F.array().cast("array<bigint>"))


def _parameters(length: int) -> tuple[int, int]:
    """(k, w) with w + k - 1 = length."""
    k = (length + 1) // 2
    return k, length - k + 1


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, thash, n_words, n_hit, n_items, item_ids`` per document:
    words inside any occurrence of an item's window, and the items met (sorted
    as strings)."""
    keyed = with_key(docs)
    item = items.select(items["item_id"].cast("string").alias("item_id"), items["text"].alias("text")) \
        .filter("item_id is not null and text is not null").distinct()
    item = item.select("item_id", exact_words(F.col("text")).alias("item_words"),
                       folded_words(F.col("text")).alias("item_folded"), F.xxhash64("text").alias("item_text"))
    item = item.filter(F.size("item_words") > 0).withColumn("span", F.least(F.lit(window), F.size("item_words")))
    item = materialize(item, "items")
    spans = sorted(r.span for r in item.select("span").distinct().collect())  # at most ``window`` numbers

    if not spans:
        none = F.lit(0).cast("long")
        return keyed.select("doc_id", "thash", F.size(folded_words(F.col("text"))).cast("long").alias("n_words"),
                            none.alias("n_hit"), none.alias("n_items"), F.array().cast("array<string>").alias("item_ids"))
    counted = materialize(_with_hits(keyed, item, spans), "fingerprints")
    out = counted.filter("span = 0").select("doc_id", "thash", "n_words")
    hits = _extended(keyed, counted, item)
    spots = hits.select("doc_id", "thash", F.explode(F.sequence("from", F.col("to") - 1)).alias("pos")) \
        .distinct().groupBy("doc_id", "thash").agg(F.count(F.lit(1)).alias("n_hit"))
    met = hits.select("doc_id", "thash", "item_id").distinct().groupBy("doc_id", "thash") \
        .agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    found = spots.withColumnsRenamed({"doc_id": "d2", "thash": "h2"}).join(
        met, F.col("d2").eqNullSafe(F.col("doc_id")) & (F.col("h2") == F.col("thash"))) \
        .select("d2", "h2", "n_hit", "n_items", "item_ids")
    return out.join(found, out["doc_id"].eqNullSafe(found["d2"]) & (out["thash"] == found["h2"]), "left").select(
        "doc_id", "thash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contaminated() -> Column:
    """The rule over ``contamination``'s columns: a twentieth of the words hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def _fingerprints(df: DataFrame, words: str, spans: list[int]) -> DataFrame:
    """``df`` with ``kept``: (span, hash) structs of the kept hashes. Each step
    is a column of its own, so no lambda computes its input again."""
    for span in spans:
        df = df.withColumn(f"grams{span}", _grams(F.col(words), _parameters(span)[0]))

    def tagged(span: int) -> Column:
        return F.transform(_kept(F.col(f"grams{span}"), _parameters(span)[1]),
                           lambda h: F.struct(F.lit(span).alias("span"), h.alias("h")))

    kept = [tagged(span) for span in spans]
    return df.withColumn("kept", F.concat(*kept)).drop(*[f"grams{span}" for span in spans])


def _with_hits(keyed: DataFrame, item: DataFrame, spans: list[int]) -> DataFrame:
    """One row per document (span 0) with its word count, and one per kept
    hash that it shares with an item."""
    prints = _fingerprints(item, "item_folded", spans) \
        .select("item_id", "item_text", F.col("span").alias("own"), F.explode("kept").alias("m")).filter("own = m.span") \
        .select("item_id", "item_text", F.col("m.span").alias("span2"), F.col("m.h").alias("h2"))
    prints = maybe_broadcast(materialize(prints, "item-fingerprints"), row_bytes=96)
    words = keyed.select("doc_id", "thash", folded_words(F.col("text")).alias("folded"))
    # A document's own row has span 0, which no item has: one pass gives both.
    own = F.array(F.struct(F.lit(0).alias("span"), F.lit(0).cast("long").alias("h")))
    rows = _fingerprints(words, "folded", spans) \
        .select("doc_id", "thash", F.size("folded").cast("long").alias("n_words"), F.explode(F.concat(own, "kept")).alias("m")) \
        .select("doc_id", "thash", "n_words", F.col("m.span").alias("span"), F.col("m.h").alias("h"))
    met = rows.join(prints, (rows["span"] == prints["span2"]) & (rows["h"] == prints["h2"]), "left") \
        .filter("span = 0 or item_id is not null")
    return met.select("doc_id", "thash", "n_words", "span", "item_id", "item_text")


def _extended(keyed: DataFrame, counted: DataFrame, item: DataFrame) -> DataFrame:
    """(doc_id, thash, item_id, from, to): the runs of equal words."""
    pairs = materialize(counted.filter("span > 0").select("doc_id", "thash", "span", "item_id", "item_text").distinct(),
                        "pairs")
    chosen = maybe_broadcast(materialize(pairs.select("doc_id", "thash").distinct(), "met-documents"), row_bytes=48)
    docs = keyed.join(chosen, same_key(keyed, chosen), "left_semi").groupBy("doc_id", "thash") \
        .agg(F.first("text").alias("text"))
    docs = docs.select("doc_id", "thash", exact_words(F.col("text")).alias("words"),
                       folded_words(F.col("text")).alias("folded"))
    docs = materialize(docs, "met-words")
    p = pairs.select(F.col("doc_id").alias("d2"), F.col("thash").alias("h2"), "item_id", "item_text")
    it = maybe_broadcast(item).withColumnsRenamed({"item_id": "i2", "item_text": "t2"})
    span_k = F.floor((F.col("span") + 1) / 2).cast("int")

    # Diagonals: where a k-gram of the item stands in the document.
    grams = it.withColumn("k", span_k).select("i2", "t2", "k", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("item_folded") - F.col("k") + 1),
        lambda i: F.xxhash64(F.slice(F.col("item_folded"), i, F.col("k"))))).alias("j", "gram"))
    sizes = pairs.select("doc_id", "thash", "span").distinct().withColumnsRenamed({"doc_id": "d3", "thash": "h3"})
    spots = docs.join(sizes, docs["doc_id"].eqNullSafe(sizes["d3"]) & (docs["thash"] == sizes["h3"])) \
        .withColumn("k", span_k).filter(F.size("folded") >= F.col("k")) \
        .select("doc_id", "thash", "k", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("folded") - F.col("k") + 1),
            lambda i: F.xxhash64(F.slice(F.col("folded"), i, F.col("k"))))).alias("i", "g"))
    shifts = spots.join(grams.withColumnRenamed("k", "k2"), (F.col("g") == F.col("gram")) & (F.col("k") == F.col("k2"))) \
        .select("doc_id", "thash", "i2", "t2", (F.col("i") - F.col("j")).alias("shift")).distinct()
    shifts = shifts.join(p, shifts["doc_id"].eqNullSafe(p["d2"]) & (shifts["thash"] == p["h2"])
                         & (F.col("i2") == F.col("item_id")) & (F.col("t2") == F.col("item_text")), "left_semi")
    shifts = shifts.withColumnsRenamed({"doc_id": "d2", "thash": "h2", "i2": "item_id", "t2": "item_text"})
    both = shifts.join(docs, docs["doc_id"].eqNullSafe(shifts["d2"]) & (docs["thash"] == shifts["h2"])) \
        .join(it, (F.col("item_id") == F.col("i2")) & (F.col("item_text") == F.col("t2")))

    # Equal words along a diagonal as a string of 0 and 1; runs of 1 are cut out.
    same = F.array_join(F.transform("item_words", lambda w, j: F.when(
        F.coalesce(F.get(F.col("words"), j + F.col("shift")) == w, F.lit(False)), F.lit("1")).otherwise(F.lit("0"))), "")
    both = both.select("doc_id", "thash", "item_id", "span", "shift", same.alias("same"))
    runs = F.regexp_extract_all("same", F.lit("(0+|1+)"), F.lit(1))
    both = both.select("doc_id", "thash", "item_id", "span", "shift", runs.alias("runs"))
    both = both.select("doc_id", "thash", "item_id", "span", "shift", F.posexplode("runs").alias("r", "run"),
                       "runs").filter(F.col("run").startswith("1") & (F.length("run") >= F.col("span")))
    start = F.col("shift") + F.length(F.array_join(F.slice(F.col("runs"), F.lit(1), F.col("r")), ""))
    return both.select("doc_id", "thash", "item_id", start.alias("from"), (start + F.length("run")).alias("to"))
