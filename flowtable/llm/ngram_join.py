"""N-gram Jaccard join by prefix filters under several global token orders.

A document is the set of its distinct ``k``-word shingles, as 64-bit hashes.
Documents with equal sets form a class; everything after that works on classes.
For a threshold t, a set of n tokens needs an overlap of a(n) = ceil(t n) with
any partner, so under *any* global order the two prefixes of length
n - a(n) + l share at least l tokens. The filters, intersected one after the
other, each one lossless:

1. under the hash order, a class stays only if enough tokens of its prefix
   (lengthened by l = n/20) also stand in another class' prefix;
2. among the classes left, the exact number of classes per token gives three
   orders (by that number; by its power of two and a hash; by another hash
   alone); a class stays only if its prefix reaches tokens that another has;
3. a candidate pair must share a prefix token under every one of the three,
   which is decided on the narrow prefixes before any set is read;
4. the whole sets are compared.

Candidates are not all pairs of a token's bucket. First each class of a bucket
is compared with the bucket's most central member (its hub) and one other; the
links found are merged into components, and from then on only pairs of
different components count: a pair of one component changes no component.

Such pairs are looked up directly in buckets of up to ``SMALL`` classes, which
is linear in the rows. A larger bucket is first split by its hub h. Let E be
the tokens of h that a class lacks, A those it has beyond h. For two classes
x, y with s common differences (in E of both, or in A of both),
  common(x, y) = |h| - |Ex| - |Ey| + s + ...  and the pair is a link only if
  (1 + t) s >= t (|h| + |Ax| + |Ay|) - (|h| - |Ex| - |Ey|).
Of two components one is not that of h, so one of the two, say x, has no link
to h, t (|h| + |Ax|) - (|h| - |Ex|) is positive, and s must be large: a prefix
filter on the differences (rare ones first) deals the classes of the bucket
into small buckets (h, difference). Buckets that are still large get a hub of
their own and are split in the same way, up to ``ROUNDS`` times.

Defined cases: null text is empty; texts without words have the empty set and
link with nothing; texts with fewer than ``k`` words are one shingle; repeated
rows and ties share a class; documents with a null doc_id take part, and do
not count for the smallest doc_id; an empty table gives no rows; other columns
are not read. Tokens are sums of 64-bit names that a cryptographic hash gives
the words: two different sets are taken for one class with a chance of about
n^2 / 2^62 over n documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.llm import arrow_text as at
from flowtable.llm.common import materialize, maybe_broadcast, same_key, with_key
from flowtable.llm.graph import components

SHINGLE = 5
THRESHOLD = (80, 100)
SHARE = 20  # the first filter asks for n // SHARE common prefix tokens
SMALL = 64  # classes of a bucket whose pairs are looked up directly
ROUNDS = 4  # times that large buckets are split by their hubs


def _overlap(n, num: int, den: int):
    """Fewest common tokens of a set of n tokens with any partner."""
    return (n * num + den - 1) // den


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row (empty without words)."""
    for _, _, offsets, data in at.slices(column):
        starts, ends, first = at.word_bounds(offsets, data)
        words = at.word_hashes(data, starts, ends, at.LOWER)
        grams = at.shingle_hashes(words, k)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            elif b > a:
                yield at.whole_hash(words[a:b])
            else:
                yield grams[:0]


def _class(tokens: np.ndarray) -> int:
    both = at.mix(tokens).sum(dtype=np.uint64, keepdims=True) + np.bitwise_xor.reduce(tokens, keepdims=True)
    return int(at.mix(both + np.uint64(len(tokens))).view(np.int64)[0])


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


ROWS = 512  # rows of an output batch


def _tokenise(k: int, prefix):
    """mapInArrow function: doc_id, thash, n, class and the sorted tokens, or
    the prefix of them that ``prefix(n)`` asks for."""
    def run(batches):
        for whole in batches:
            for at_row in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at_row, ROWS)
                ns, classes, tokens = [], [], []
                for s in _sets(batch.column("text"), k):
                    ns.append(len(s))
                    classes.append(_class(s) if len(s) else 0)
                    tokens.append(s if prefix is None else s[:prefix(len(s))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("thash"), pa.array(ns, pa.int64()),
                     pa.array(classes, pa.int64()), _list_array(tokens)],
                    names=["doc_id", "thash", "n", "class", "tokens"])
    return run


_SCHEMA = "doc_id long, thash long, n long, class long, tokens array<long>"


def _first_filter(docs: DataFrame, num: int, den: int) -> DataFrame:
    """Classes that enough of their hash-order prefix shares with another class:
    (class, n)."""
    tokens = docs.filter("n > 0").select("class", F.explode("tokens").alias("token"))
    alone = tokens.groupBy("token").agg(F.min("class").alias("class"), F.max("class").alias("c2")) \
        .filter("class = c2").groupBy("class").agg(F.count(F.lit(1)).alias("n_alone"))
    classes = docs.filter("n > 0").groupBy("class").agg(F.max("n").alias("n"), F.max(F.size("tokens")).alias("p"))
    # The smallest possible partner has a(n) tokens, and so the shorter prefix.
    smallest = f"((n * {num} + {den - 1}) div {den})"
    need = F.greatest(F.lit(1), F.expr(f"(({smallest} * {num} + {den - 1}) div {den}) div {SHARE}"))
    return classes.join(alone, "class", "left") \
        .filter(F.col("p") - F.coalesce("n_alone", F.lit(0)) >= need).select("class", "n")


def _orders(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(class, n, m, central, p0, p1, p2): prefixes under three
    orders, without tokens that only one class has; ``m`` counts the others and
    ``central`` is the mean number of classes of a token. Classes with an
    empty prefix are left out."""
    tokens = sets.select("class", "n", F.explode("tokens").alias("token"))
    df = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    df = df.withColumnRenamed("token", "t2")
    shared = tokens.join(df, tokens["token"] == df["t2"])
    per_class = shared.groupBy("class").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("m"), F.sum("df").alias("weight"),
        F.collect_list(F.struct("df", "token")).alias("shared"))
    # The n - m tokens of one class alone come first in every order.
    length = F.expr(f"cast(m - (n * {num} + {den - 1}) div {den} + 1 as int)")
    per_class = per_class.withColumn("length", length).filter("length > 0")
    ranked = lambda *first: F.sort_array(F.transform("shared", lambda s: F.struct(
        *[f(s).alias(f"k{i}") for i, f in enumerate(first)], s["token"].alias("token"))))
    orders = [F.sort_array("shared"),
              ranked(lambda s: F.floor(F.log2(s["df"])), lambda s: F.xxhash64(s["token"], F.lit(7))),
              ranked(lambda s: F.xxhash64(s["token"], F.lit(11)))]
    return per_class.select("class", "n", "m", (F.col("weight") / F.col("n")).alias("central"), *[
        F.transform(F.slice(o, F.lit(1), F.col("length")), lambda s: s["token"]).alias(f"p{i}")
        for i, o in enumerate(orders)])


def _near(num: int, den: int) -> Column:
    """Whether classes of (n, m) and (n2, m2) can reach the threshold at all:
    common tokens are among both sides' m, and the union holds the larger m
    and every token that only one class has."""
    return F.expr(f"least(m, m2) * {den} >= (greatest(m, m2) + (n - m) + (n2 - m2)) * {num}")


def _filtered(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under the other orders too."""
    narrow = lambda at: orders.select(*[F.col(c).alias(f"{at}_{c}") for c in ("class", "p1", "p2")])
    a, b = narrow("a"), narrow("b")
    both = pairs.join(a, pairs["a"] == a["a_class"]).join(b, pairs["b"] == b["b_class"])
    return both.filter("arrays_overlap(a_p1, b_p1) and arrays_overlap(a_p2, b_p2)").select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, orders: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes that pass the other orders and whose whole sets
    reach the threshold: (a, b, common)."""
    kept = _filtered(pairs, orders)
    side = lambda at: sets.select(*[F.col(c).alias(f"{at}_{c}") for c in ("class", "n", "tokens")])
    a, b = side("a"), side("b")
    both = kept.join(a, kept["a"] == a["a_class"]).join(b, kept["b"] == b["b_class"])
    both = both.filter(f"a_n * {den} >= b_n * {num} and b_n * {den} >= a_n * {num}") \
        .select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_tokens", "b_tokens")).alias("common"))
    return both.filter(f"common * {den} >= (a_n + b_n - common) * {num}").select("a", "b", "common")


def _open(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows of the buckets with classes of two components or more, with
    ``comp`` and ``size``."""
    rows = buckets.drop("comp", "size")
    rows = rows.join(comps, rows["class"] == comps["node"], "left") \
        .withColumn("comp", F.coalesce("root", "class")).drop("node", "root")
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("c1"), F.max("comp").alias("c2")) \
        .filter("c1 <> c2").select(F.col("key").alias("k2"), "size")
    return rows.join(many, rows["key"] == many["k2"]).drop("k2")


def _crossing(linked: DataFrame, comps: DataFrame) -> DataFrame:
    """The links (a, b) of classes with their hubs that join two components."""
    hubs, own = comps.toDF("n1", "r1"), comps.toDF("n2", "r2")
    both = linked.join(hubs, F.col("hub") == F.col("n1"), "left").join(own, F.col("class") == F.col("n2"), "left")
    return both.filter(F.coalesce("r1", "hub") != F.coalesce("r2", "class")) \
        .select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b"))


def _direct(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) across components within the buckets."""
    other = rows.select("key", *[F.col(c).alias(f"{c}2") for c in ("class", "n", "m", "comp", "w", "d")]) \
        .withColumnsRenamed({"class2": "c2", "key": "k2"})
    differences = F.expr(f"least(d, d2) * {num + den} >= w + w2 - slack")
    return rows.join(other, (rows["key"] == other["k2"]) & (F.col("class") < F.col("c2")) & (F.col("comp") != F.col("comp2"))
                     & _near(num, den) & differences).select(F.col("class").alias("a"), F.col("c2").alias("b")).distinct()


def _spokes(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(hub, class, n, m, central, h, linked, e, a): each class of a bucket
    against the bucket's hub, with the tokens it lacks (e) and has beyond (a)."""
    hubs = rows.groupBy("key").agg(F.max(F.struct("central", "class")).alias("top")) \
        .select(F.col("key").alias("k2"), F.col("top.class").alias("hub"))
    met = rows.join(hubs, rows["key"] == hubs["k2"]).filter("class <> hub") \
        .select("hub", "class", "n", "m", "central").distinct()
    met = materialize(met, "spokes")
    centres = materialize(sets.join(met.select("hub").distinct(), sets["class"] == F.col("hub"), "left_semi")
                          .select(F.col("class").alias("h2"), F.col("n").alias("h"), F.col("tokens").alias("centre")), "hubs")
    own = sets.select(F.col("class").alias("c2"), "tokens")
    both = met.join(own, met["class"] == own["c2"]).join(maybe_broadcast(centres), F.col("hub") == F.col("h2"))
    both = both.withColumn("e", F.array_except("centre", "tokens")).withColumn("a", F.array_except("tokens", "centre"))
    linked = F.expr(f"(h - size(e)) * {den} >= (h + size(a)) * {num}")
    return both.select("hub", "class", "n", "m", "central", "h", linked.alias("linked"), "e", "a")


def _split(spokes: DataFrame, num: int, den: int) -> DataFrame:
    """Buckets (hub, difference) from the differences: rows as in ``_open``,
    with d (differences that others share) and w (their weight)."""
    tagged = F.concat(F.col("a"), F.transform("e", lambda t: F.bitwise_not(t)))
    rows = spokes.withColumn("w", F.expr(f"cast({num} * size(a) + {den} * size(e) as long)")) \
        .withColumn("slack", F.expr(f"cast({den - num} * h as long)"))
    # Fewest differences that a class shares with any partner of another component.
    least = F.when(F.col("linked"), F.ceil((F.col("w") + 1) / (num + den))).otherwise(F.ceil((F.col("w") - F.col("slack")) / den))
    rows = rows.withColumn("least", F.greatest(F.lit(1), least.cast("long")))
    each = rows.select("hub", "class", "n", "m", "central", "w", "slack", "least", F.explode(tagged).alias("t"))
    df = each.groupBy("hub", "t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").withColumnsRenamed({"hub": "h2", "t": "t2"})
    shared = each.join(df, (each["hub"] == df["h2"]) & (each["t"] == df["t2"]))
    per = shared.groupBy("hub", "class").agg(
        *[F.first(c).alias(c) for c in ("n", "m", "central", "w", "slack", "least")],
        F.sort_array(F.collect_list(F.struct("df", "t"))).alias("ranked"))
    per = per.withColumn("d", F.size("ranked").cast("long")).filter("d >= least")
    prefix = F.slice("ranked", F.lit(1), (F.col("d") - F.col("least") + 1).cast("int"))
    return per.select("hub", "class", "n", "m", "central", "w", "slack", "d", F.explode(prefix).alias("p")) \
        .select(F.xxhash64("hub", "p.t").alias("key"), "class", "n", "m", "central", "w", "slack", "d")


def _prepared(docs: DataFrame, k: int, num: int, den: int):
    """(documents with n and class, candidate sets, their order prefixes)."""
    keyed = with_key(docs)
    prefix = lambda n: n - _overlap(n, num, den) + max(1, _overlap(n, num, den) // SHARE)
    hashed = materialize(keyed.mapInArrow(_tokenise(k, prefix), _SCHEMA), "shingles")
    left = materialize(_first_filter(hashed, num, den), "candidates")
    # One row of each class left; its whole set is computed again from the text.
    rep = hashed.join(left.select("class"), "class", "left_semi").groupBy("class").agg(
        F.min(F.struct("doc_id", "thash")).alias("r")).select("r.doc_id", "r.thash")
    rep = maybe_broadcast(materialize(rep, "representatives"), row_bytes=48)
    chosen = keyed.join(rep, same_key(keyed, rep), "left_semi")
    sets = chosen.mapInArrow(_tokenise(k, None), _SCHEMA).groupBy("class").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    sets = materialize(sets, "sets")
    return hashed, sets, materialize(_orders(sets, num, den), "orders")


def jaccard_links(docs: DataFrame, k: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Every link between classes of different sets: (a, b, common), a < b,
    as class ids of ``jaccard_components``."""
    num, den = threshold
    _, sets, orders = _prepared(docs, k, num, den)
    t = orders.select("class", "n", "m", F.explode("p0").alias("token"))
    u = t.withColumnsRenamed({"class": "c2", "n": "n2", "m": "m2", "token": "t2"})
    pairs = t.join(u, (t["token"] == u["t2"]) & (t["class"] < u["c2"]) & _near(num, den)) \
        .select(F.col("class").alias("a"), F.col("c2").alias("b")).distinct()
    return _verified(pairs, sets, orders, num, den)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, thash, n_shingles, class_id, group_id,
    component_id``. Documents of one class have equal sets, those of one group
    reach each other by links; both are null for empty sets. ``component_id``
    is the smallest doc_id that links reach, its own included."""
    num, den = threshold
    hashed, sets, orders = _prepared(docs, k, num, den)
    plain = F.lit(0).cast("long")
    buckets = orders.select(F.explode("p0").alias("key"), "class", "n", "m", "central", plain.alias("w"), plain.alias("slack"),
                            F.col("m").alias("d"))

    # Each class of a bucket against its most central set (of near copies, the
    # one that they were made from) and one other.
    ends = buckets.groupBy("key").agg(F.max(F.struct("central", "class", "n", "m")).alias("hi"),
                                      F.min(F.struct("class", "n", "m")).alias("lo"), F.count(F.lit(1)).alias("size"))
    hub = lambda c: F.struct(F.col(f"{c}.class").alias("c2"), F.col(f"{c}.n").alias("n2"), F.col(f"{c}.m").alias("m2"))
    ends = ends.filter("size > 1").select(F.col("key").alias("k2"), F.array(hub("hi"), hub("lo")).alias("hubs"))
    starred = buckets.join(ends, buckets["key"] == ends["k2"]).select("class", "n", "m", F.explode("hubs").alias("hub")) \
        .select("class", "n", "m", "hub.c2", "hub.n2", "hub.m2").filter((F.col("class") != F.col("c2")) & _near(num, den)) \
        .select(F.least("class", "c2").alias("a"), F.greatest("class", "c2").alias("b")).distinct()
    links = materialize(_verified(starred, sets, orders, num, den).select("a", "b"), "star-links")
    comps = materialize(components(links), "star-components")

    pairs = None
    for _ in range(ROUNDS):
        now = materialize(_open(buckets, comps), "open-buckets")
        found = _direct(now.filter(F.col("size") <= SMALL), num, den)
        pairs = found if pairs is None else pairs.unionAll(found)
        large = now.filter(F.col("size") > SMALL)
        if large.isEmpty():
            break
        spokes = materialize(_spokes(large, sets, num, den), "differences")
        buckets = _split(spokes, num, den)
        new = materialize(_crossing(spokes.filter("linked"), comps), "new-links")
        if not new.isEmpty():  # most hubs are those of the first comparison
            links = links.unionAll(new)
            comps = materialize(components(links), "components")
    else:
        pairs = pairs.unionAll(_direct(_open(buckets, comps), num, den))
    more = materialize(_verified(pairs.distinct(), sets, orders, num, den).select("a", "b"), "cross-links")
    comps = components(links.unionAll(more))

    least = hashed.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    placed = least.join(comps, least["class"] == comps["node"], "left") \
        .select("class", "low", F.coalesce("root", "class").alias("root"))
    low = placed.groupBy("root").agg(F.min("low").alias("component")).withColumnRenamed("root", "r2")
    found = placed.join(low, placed["root"] == low["r2"]).select(F.col("class").alias("c2"), "root", "component")
    out = hashed.join(found, (hashed["class"] == found["c2"]) & (hashed["n"] > 0), "left")
    return out.select("doc_id", "thash", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("class")).alias("class_id"), F.col("root").alias("group_id"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, thash) of the documents to drop so that one of each group
    stays: that with the smallest doc_id (null ids last), then text hash."""
    rows = materialize(jaccard_components(docs, k, threshold).filter("group_id is not null")
                       .select("doc_id", "thash", "group_id"), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "thash")
    kept = rows.groupBy("group_id").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("c")).filter("c > 1") \
        .withColumnRenamed("group_id", "g2")
    return materialize(rows.join(kept, rows["group_id"] == kept["g2"]).filter(F.col("kept") != place)
                       .select("doc_id", "thash").distinct(), "near-duplicates")
