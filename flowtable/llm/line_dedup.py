"""Line dedup by a suffix array over line ids, with DataFrame functions only.

All documents' lines are one long sequence of line ids. Prefix doubling ranks
the runs of 1, 2, 4, ... lines that start at each place: the rank of a run of
2h lines is the place of the pair (rank of its first half, rank of its second
half) among all sorted pairs. Runs that occur once are dropped on the way, so
later rounds work on repeated text only.

Suffixes that share a prefix of at least ``min_words`` words form one interval
of the suffix array; two suffixes are in one interval exactly when their
shortest prefixes of ``min_words`` words are equal, and such a prefix of m
lines is named by its length and the ranks of its first and last 2^j lines (2^j
<= m < 2^(j+1)). It has at most ``min_words`` lines, so six rounds are enough
for 50 words whatever the data. The same is done for the shortest suffixes of
``min_words`` words that end at a line. Both together cover a maximal repeated
run completely: a line with enough words before it in the run lies in the
prefix that ends at it, any other line in the prefix that starts the run.

The rule, exactly: a line is deleted if it lies in a run of consecutive lines
of its document, with ``min_words`` words or more, that occurs at an earlier
place (by doc_id, text hash, line) without overlapping it.

Only lines with a word count (words are cut at space and 0x09-0x0D); lines
without one separate nothing and stay, except that a text of which no word is
left becomes empty. Defined cases: null text is empty; null doc_ids come
first; repeated rows (same doc_id and text) are one document and get the same
result; empty tables give no rows; texts of any length are read whole; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtable.llm.common import fresh, materialize, maybe_broadcast, with_key

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"


def _n_words(line: Column) -> Column:
    """Words of a line: runs of other characters than white space."""
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")


def _lines(keyed: DataFrame) -> DataFrame:
    """(doc, pos, line_at, id, words, before, total): the lines with a word of
    each distinct (doc_id, text), numbered without gaps."""
    rows = keyed.select("doc_id", "thash", F.posexplode(F.split("text", "\n", -1)).alias("line_at", "line"))
    rows = rows.select("doc_id", "thash", "line_at", F.unhex(F.md5("line")).alias("id"), _n_words(F.col("line")).alias("words")) \
        .filter("words > 0")
    rows = rows.repartition("doc_id", "thash").dropDuplicates(["doc_id", "thash", "line_at"])
    by_doc = Window.partitionBy("doc_id", "thash")
    in_order = by_doc.orderBy("line_at")
    return rows.select("doc_id", "thash", "line_at", "id", "words",
                       F.row_number().over(in_order).alias("pos"),
                       (F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("before"),
                       F.sum("words").over(by_doc).alias("total"))


def _ranked(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct key tuples that occur twice or more, with ``rank``: their
    place in sorted order (range partitions sorted one by one; the partition
    number leads the rank)."""
    twice = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(*keys)
    return materialize(twice.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), name)


def _levels(lines: DataFrame, rounds: int) -> DataFrame:
    """(doc_id, thash, pos, level, rank): ranks of the repeated runs of
    2^level lines."""
    place = ["doc_id", "thash", "pos"]
    ids = _ranked(lines, ["id"], "ranks0").withColumnRenamed("id", "id2")
    now = materialize(lines.join(ids, lines["id"] == ids["id2"]).select(*place, "rank"), "level0")
    out = now.withColumn("level", F.lit(0))
    for level in range(1, rounds):
        h = 1 << (level - 1)
        ahead = Window.partitionBy("doc_id", "thash").orderBy("pos").rangeBetween(h, h)
        pairs = now.withColumn("next", F.first("rank").over(ahead)).filter("next is not null")
        ranks = _ranked(pairs.select(F.col("rank").alias("r1"), F.col("next").alias("r2")), ["r1", "r2"], f"ranks{level}") \
            .withColumnRenamed("rank", "new")
        now = materialize(pairs.join(ranks, (pairs["rank"] == ranks["r1"]) & (pairs["next"] == ranks["r2"]))
                          .select(*place, F.col("new").alias("rank")), f"level{level}")
        out = out.unionByName(now.withColumn("level", F.lit(level)))
    return out


def repeated_runs(keyed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, thash, line_at): the lines to delete."""
    lines = materialize(_lines(keyed), "lines")
    rounds = max(1, min_words.bit_length())
    levels = _levels(lines, rounds)

    doc = Window.partitionBy("doc_id", "thash")
    lines = lines.withColumn("through", F.col("before") + F.col("words"))
    # Lines of the shortest run of min_words words that starts, or ends, at a line.
    ahead = doc.orderBy("before").rangeBetween(1, min_words - 1)
    behind = doc.orderBy("through").rangeBetween(-(min_words - 1), -1)
    runs = lines.select("doc_id", "thash", "pos", "before", "through", "total",
                        (F.count(F.lit(1)).over(ahead) + 1).alias("fwd"),
                        (F.count(F.lit(1)).over(behind) + 1).alias("back"))
    starting = F.when(F.col("total") - F.col("before") >= min_words, F.struct(F.col("pos").alias("s"), F.col("fwd").alias("m")))
    ending = F.when(F.col("through") >= min_words,
                    F.struct((F.col("pos") - F.col("back") + 1).cast("int").alias("s"), F.col("back").alias("m")))
    runs = runs.select("doc_id", "thash", F.explode(F.array_distinct(F.array_compact(F.array(starting, ending)))).alias("r")) \
        .select("doc_id", "thash", F.col("r.s").alias("s"), F.col("r.m").alias("m")).distinct()
    runs = runs.withColumn("level", (F.length(F.bin("m")) - 1).cast("int"))
    runs = runs.withColumn("tail", F.expr("cast(s + m - shiftleft(1, level) as int)"))

    def look_up(df: DataFrame, at: str, name: str) -> DataFrame:
        t = levels.select(F.col("doc_id").alias("d2"), F.col("thash").alias("h2"), F.col("pos").alias("p2"),
                          F.col("level").alias("l2"), F.col("rank").alias(name))
        return df.join(t, df["doc_id"].eqNullSafe(t["d2"]) & (df["thash"] == t["h2"]) & (df[at] == t["p2"])
                       & (df["level"] == t["l2"])).drop("d2", "h2", "p2", "l2")

    named = materialize(look_up(look_up(runs, "s", "r1"), "tail", "r2")
                        .select("doc_id", "thash", "s", "m", "r1", "r2"), "runs")
    # Intervals of the suffix array, and the earliest place of each.
    place = F.struct("doc_id", "thash", "s")
    first = named.groupBy("m", "r1", "r2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1") \
        .select(F.col("m").alias("m2"), F.col("r1").alias("a2"), F.col("r2").alias("b2"), "first")
    later = named.join(first, (named["m"] == first["m2"]) & (named["r1"] == first["a2"]) & (named["r2"] == first["b2"]))
    other_doc = ~(F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.thash") == F.col("thash")))
    later = later.filter(other_doc | (F.col("first.s") + F.col("m") <= F.col("s"))) \
        .filter(F.col("first") != F.struct("doc_id", "thash", "s"))
    gone = later.select("doc_id", "thash", F.explode(F.sequence(F.col("s"), (F.col("s") + F.col("m") - 1).cast("int"))).alias("pos")) \
        .distinct()
    at = lines.select(F.col("doc_id").alias("d2"), F.col("thash").alias("h2"), F.col("pos").alias("p2"), "line_at")
    return gone.join(at, gone["doc_id"].eqNullSafe(at["d2"]) & (gone["thash"] == at["h2"]) & (gone["pos"] == at["p2"])) \
        .select("doc_id", "thash", "line_at")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its rows, and ``text`` without the later copies; plus
    ``thash`` (of the old text), ``n_lines`` and ``n_removed``. Columns of
    these three names in ``docs`` give way to them; all others come back."""
    own = ("thash", "n_lines", "n_removed")
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in own])
    by_id, by_hash, gone, lines = fresh(docs, "gone_id", "gone_hash", "gone", "lines")
    deleted = repeated_runs(with_key(docs), min_words).groupBy("doc_id", "thash") \
        .agg(F.collect_list("line_at").alias(gone)).withColumnsRenamed({"doc_id": by_id, "thash": by_hash})
    deleted = maybe_broadcast(materialize(deleted, "deleted-lines"))
    old = docs.withColumn("thash", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    both = old.join(deleted, old["doc_id"].cast("long").eqNullSafe(deleted[by_id]) & (old["thash"] == deleted[by_hash]), "left")
    both = both.withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    rest = F.when(rest.rlike(_WORD), rest).otherwise(F.lit(""))
    both = both.withColumn("n_lines", F.size(lines).cast("long")).withColumn(
        "n_removed", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
    both = both.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest))
    return both.drop(by_id, by_hash, gone, lines)
