"""Text extraction: n-th regex match over lines, nested pattern detection,
extraction to a column or to the content."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.functions.text import group_may_be_empty, java_regex_groups, let, text_lines
from flowtable.session import spread


def nth_match_value(text: Column, regex: str, occurrence: int, group_support: bool,
                    has_group: bool = True, unset_is_empty: bool = False) -> Column:
    """Struct(cnt, value, hit) of the ``occurrence``-th regex match over the lines of ``text``.

    Matches are counted across lines (zero-length ones too). The line that holds
    match k gives the value: group 1 (or the whole line) of the *last* match on
    that line. k <= 0 never matches. Group mode on a pattern without a group 1
    gives no value, and so does a line on which group 1 takes no part in match k
    or a later one. Spark's functions give such a group as the empty string:
    with ``unset_is_empty`` (group 1 cannot match nothing) an empty value is an
    unset group. The fold runs inside one row: no shuffle, whole texts.
    """
    lines = text_lines(text)
    k = F.lit(int(occurrence)).cast("long")
    init = F.struct(F.lit(0).cast("long").alias("cnt"), F.lit(None).cast("string").alias("value"),
                    F.lit(False).alias("hit"))
    if occurrence <= 0 or (group_support and not has_group):
        # Counter starts at 1 and only grows: k <= 0 is never reached; a missing
        # group 1 fails on assignment, which yields no value.
        return F.struct(F.lit(0).cast("long").alias("cnt"), F.lit(None).cast("string").alias("value"),
                        F.lit(False).alias("hit"))

    def step(acc: Column, line: Column) -> Column:
        def advance(total: Column) -> Column:
            if group_support:
                groups = F.regexp_extract_all(line, F.lit(regex), 1)
                picked = F.element_at(groups, -1)
                if unset_is_empty:
                    # Match k and those after it on this line: none of them unset.
                    from_k = let(groups, lambda g: F.slice(g, (F.size(g) - (total - k)).cast("int"), F.size(g)))
                    picked = F.when(~F.exists(from_k, lambda v: v == F.lit("")), picked)
            else:
                picked = line
            reached = F.struct(total.alias("cnt"), picked.alias("value"), F.lit(True).alias("hit"))
            pending = F.struct(total.alias("cnt"), F.lit(None).cast("string").alias("value"),
                               F.lit(False).alias("hit"))
            return F.when(total >= k, reached).otherwise(pending)

        # Lines after the hit are not scanned; the match count is bound once per line.
        n = F.size(F.regexp_extract_all(line, F.lit(regex), 0)).cast("long")
        return F.when(acc["hit"], acc).otherwise(F.aggregate(F.array(acc["cnt"] + n), init, lambda _a, t: advance(t)))

    return F.aggregate(lines, init, step)


def nth_match(df: DataFrame, key_cols: Sequence[str], text_col: str, regex: str, occurrence: int,
              group_support: bool = True) -> DataFrame:
    """One row per input row: key columns, ``found``, ``value`` and ``route``.

    An invalid regex routes every row to ``failure`` (found = false); otherwise
    every row is ``success`` whether or not a value was found.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in key_cols]
    try:
        groups = java_regex_groups(spark, regex)
    except ValueError:
        return df.select(*keys, F.lit(False).alias("found"), F.lit(None).cast("string").alias("value"),
                         F.lit("failure").alias("route"))
    unset_is_empty = group_support and groups >= 1 and not group_may_be_empty(spark, regex)
    res = nth_match_value(F.col(text_col), regex, occurrence, group_support, groups >= 1, unset_is_empty)
    # The fold is projected once; fields are read from the projected struct.
    out = df.select(*keys, res.alias("_nth"))
    return out.select(*key_cols, F.coalesce(F.col("_nth.hit") & F.col("_nth.value").isNotNull(), F.lit(False)).alias("found"),
                      F.col("_nth.value").alias("value"),
                      F.lit("success").alias("route"))


@dataclass
class Detector:
    """One node of a detection definition tree.

    ``pattern`` plays the role of a classifier; ``crop`` makes the matched text
    the input of the children (the last match wins), ``children`` run as a
    chain, each on the previous child's result.
    """

    name: str
    pattern: str
    crop: bool = False
    draw_bounds: bool = False
    children: list["Detector"] = field(default_factory=list)

    @staticmethod
    def from_dict(d: dict) -> "Detector":
        def flag(v):
            return v if isinstance(v, bool) else str(v).strip().lower() == "true"
        return Detector(
            name=d["name"], pattern=d["pattern"], crop=flag(d.get("crop", False)),
            draw_bounds=flag(d.get("drawBounds", d.get("draw_bounds", False))),
            children=[Detector.from_dict(c) for c in d.get("children", [])],
        )


_DETECTION = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()), T.StructField("content", T.StringType()),
])


def nested_detect(df: DataFrame, key_col: str, text_col: str, definitions: Sequence[Detector | dict]) -> DataFrame:
    """One output row per detection: key, path, name, ordinal (1-based), content.

    Definitions run in order on the input text. Within a definition, the
    children form a chain: the first child runs on the parent's last crop (or
    the parent's input when the parent cropped nothing or does not crop), each
    next child on its predecessor's result. Children run even when the parent
    found nothing. Rows with no detection at all get one row routed
    ``no_object_detected`` (name and content null).

    The definition tree is folded on the driver into per-row array
    expressions; detections are exploded once at the end (no shuffle).
    """
    defs = [d if isinstance(d, Detector) else Detector.from_dict(d) for d in definitions]
    pieces: list[Column] = []
    cur = spread(df, heavy=True).select(F.col(key_col), F.col(text_col).alias("_in"))
    counter = [0]

    def run(node: Detector, content: str, prefix: str) -> str:
        """Adds this node's matches as their own column (computed once) and
        returns the column holding the node's result content."""
        nonlocal cur
        if node.draw_bounds:
            raise ValueError("draw_bounds marks images; a text has no bounds to draw")
        i = counter[0]
        counter[0] += 1
        path = f"{prefix}/{node.name}" if prefix else node.name
        found, result = f"_m{i}", f"_c{i}"
        cur = cur.withColumn(found, F.regexp_extract_all(F.col(content), F.lit(node.pattern), 0))
        pieces.append(F.transform(F.col(found), lambda m, j: F.struct(
            F.lit(path).alias("path"), F.lit(node.name).alias("name"),
            (j + 1).cast("int").alias("ordinal"), m.alias("content"))))
        if node.crop:
            cur = cur.withColumn(result, F.when(F.size(F.col(found)) > 0, F.element_at(F.col(found), -1))
                                 .otherwise(F.col(content)))
        else:
            result = content
        current = result
        for child in node.children:
            current = run(child, current, path)
        return current

    for d in defs:
        run(d, "_in", "")
    everything = F.flatten(F.array(*pieces)) if pieces else F.array().cast(T.ArrayType(_DETECTION))
    out = cur.select(F.col(key_col), F.explode_outer(everything).alias("d"))
    return out.select(
        key_col, F.col("d.path").alias("path"), F.col("d.name").alias("name"),
        F.col("d.ordinal").alias("ordinal"), F.col("d.content").alias("content"),
        F.when(F.col("d").isNull(), F.lit("no_object_detected")).otherwise(F.lit("success")).alias("route"),
    )


def extract_to(df: DataFrame, col: str, regex: str, destination: str = "attribute",
               attribute: str = "extracted", group: int = 0) -> DataFrame:
    """First regex match written to a new column (``attribute``) or over the
    content column (``content``); rows without a match route ``failure`` and
    keep their content unchanged."""
    if destination not in ("attribute", "content"):
        raise ValueError("destination must be 'attribute' or 'content'")
    spark = df.sparkSession
    groups = java_regex_groups(spark, regex)
    if group > groups:
        raise ValueError(f"regex has {groups} groups, asked for group {group}")
    hit = F.col(col).rlike(regex)
    value = F.when(hit, F.regexp_extract(F.col(col), regex, group))
    route = F.when(hit, F.lit("success")).otherwise(F.lit("failure"))
    if destination == "attribute":
        return df.withColumn(attribute, value).withColumn("route", route)
    return df.withColumn(col, F.coalesce(value, F.col(col))).withColumn("route", route)
