"""URL filter: allow and block rules, and gradient-boosted trees over lexical
features for the URLs that no rule decides. DataFrame functions only.

A rule names a host and a path prefix; it fits the host and all its subdomains
where the URL's path starts with the prefix; the longest fitting rule wins.
The trees (Spark ML's ``GBTClassifier``) learn from labelled URLs: by default
a bounded sample (``SAMPLE``) of the URLs that the rules decide. Features are
length, depth, digit ratio, character entropy, parameter counts and how common
the host's last two labels are (statistics over all URLs).

Defined cases: a null URL or one without ``://`` has empty host and path and
all-zero features; URLs of any length are read whole; repeated rows get equal
results; without labelled URLs of both classes undecided URLs are allowed; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.llm.common import materialize, maybe_broadcast

SAMPLE = 5000  # labelled URLs the trees are fitted on, at most
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_length", "f_host", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_dots", "f_hyphens",
            "f_letters_host", "f_suffix", "f_suffix2")

Rule = tuple[str, str, str]  # verdict, host, path prefix


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``."""
    url = F.coalesce(pages["url"], F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    parts = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"), rest.alias("rest"))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(F.col("rest"), F.length(raw) + 1, F.length("rest")), r"^[^?#]*", 0)
    return parts.select("page_id", "url", F.translate(raw, UPPER, LOWER).alias("host"), path.alias("path"))


def _fits(host: str, path: str) -> Column:
    return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)


def with_rule(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule`` (host and path of the longest that fits, else null) and
    ``rule_verdict``. Equally long rules: the first of the list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(v)).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _suffix(n: int) -> Column:
    return F.substring_index("host", ".", -n)


def suffix_statistics(parts: DataFrame) -> DataFrame:
    """How often each last label and each last two labels of a host occur:
    (suffix, share of all URLs)."""
    both = parts.select(F.explode(F.array(F.concat(F.lit("1 "), _suffix(1)), F.concat(F.lit("2 "), _suffix(2)))).alias("suffix"))
    counts = materialize(both.groupBy("suffix").agg(F.count(F.lit(1)).alias("c")), "suffixes")
    total = parts.count()
    return counts.select("suffix", F.log1p(F.col("c") * 1e6 / max(1, total)).alias("share"))


def with_features(parts: DataFrame, suffixes: DataFrame) -> DataFrame:
    chars = F.split(F.coalesce("url", F.lit("")), "", -1)
    parts = parts.withColumn("chars", F.filter(chars, lambda c: c != "")) \
        .withColumn("kinds", F.array_distinct("chars"))
    n = F.size("chars")
    # Entropy from how often each distinct character occurs in the URL.
    share = F.transform("kinds", lambda c: (n - F.length(F.replace(F.coalesce("url", F.lit("")), c, F.lit("")))) / n)
    parts = parts.withColumn("shares", share)
    entropy = F.aggregate("shares", F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    count = lambda c, s: (F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))).cast("double")
    url = F.coalesce("url", F.lit(""))
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    query = F.substring_index(F.when(F.contains(url, F.lit("?")), F.substring(url, F.locate("?", url) + 1, F.length(url)))
                              .otherwise(F.lit("")), "#", 1)
    parts = parts.select(
        *[c for c in parts.columns if c not in ("chars", "kinds", "shares")],
        F.length(url).cast("double").alias("f_length"), F.length("host").cast("double").alias("f_host"),
        count(F.col("path"), "/").alias("f_depth"), F.coalesce(digits / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("f_digits"),
        F.coalesce(entropy, F.lit(0.0)).alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(count(query, "&") + 1).alias("f_parameters"),
        count(F.col("host"), ".").alias("f_dots"), count(F.col("host"), "-").alias("f_hyphens"),
        F.length(F.substring_index("host", ".", 1)).cast("double").alias("f_letters_host"))
    for n_labels, name in ((1, "f_suffix"), (2, "f_suffix2")):
        side = suffixes.select(F.col("suffix").alias("s"), F.col("share").alias(name))
        parts = parts.join(maybe_broadcast(side), F.concat(F.lit(f"{n_labels} "), _suffix(n_labels)) == F.col("s"), "left") \
            .drop("s").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return parts


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(features)


def train(labelled: DataFrame, limit: int = SAMPLE) -> GBTClassificationModel | None:
    """Trees from rows of the feature columns, ``url`` and ``label`` (1.0:
    block). The sample is chosen by a hash of the URL; None without both classes."""
    rows = labelled.select("url", "label", *FEATURES).orderBy(F.xxhash64("url"), "url", "label").limit(limit)
    rows = materialize(rows, "labelled-urls").coalesce(1)
    if rows.select("label").distinct().count() < 2:
        return None
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=3, maxBins=32, seed=1).fit(_vectors(rows))


def judge(pages: DataFrame, rules: list[Rule], limit: int = SAMPLE) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` of every page."""
    parts = with_rule(with_parts(pages), rules)
    features = materialize(with_features(parts, suffix_statistics(parts)), "url-features")
    labelled = features.filter("rule is not null").withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    model = train(labelled, limit)
    if model is None:
        judged = features.withColumn("learned", F.lit("allow"))
    else:
        judged = model.transform(_vectors(features)).withColumn(
            "learned", F.when(F.col("prediction") == 1.0, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "url", "host", "path", "rule", F.coalesce("rule_verdict", "learned").alias("verdict"))
