"""Projections and scalar enrichment: templates, extension rewrite, lookups,
``k=v`` parsing, list splitting and metric documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.session import small_side, spread

_PLACEHOLDER = re.compile(r"\$\{([^}]*)\}")


def template_column(template: str, columns: list[str]) -> Column:
    """``'... ${attr} ...'`` as a concat of literals and string-cast columns.

    The template is parsed once on the driver; a placeholder naming no column
    (or a null value) becomes the empty string.
    """
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1).strip()
        if name in columns:
            parts.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def put_content(df: DataFrame, template: str, content_col: str = "content") -> DataFrame:
    """Replace (or add) the content column with ``template`` evaluated per row."""
    return df.withColumn(content_col, template_column(template, df.columns))


def rewrite_extension(df: DataFrame, col: str, extension: str = ".jpg", out_col: str | None = None) -> DataFrame:
    """Replace the last dot and what follows it by ``extension``; names
    without a dot, empty or null stay unchanged."""
    name = F.col(col)
    replacement = extension.replace("\\", "\\\\").replace("$", "\\$")
    new = F.when(name.contains("."), F.regexp_replace(name, r"\.[^.]*\z", replacement)).otherwise(name)
    return df.withColumn(out_col or col, new)


def lookup_enrich(df: DataFrame, key_col: str, map_df: DataFrame, map_key: str = "key",
                  map_value: str = "value", out_col: str = "value", default: str | None = None) -> DataFrame:
    """Case-insensitive lookup of ``key_col`` in ``map_df``; misses get ``default``.

    Keys equal ignoring case keep the value of the smallest original key. The
    lookup side is broadcast only when its row count is proven small;
    otherwise both sides shuffle on the lower-cased key.
    """
    lookup = (map_df.select(F.lower(F.col(map_key)).alias("_lk"), F.col(map_key).alias("_k"),
                            F.col(map_value).alias("_v"))
              .groupBy("_lk").agg(F.min_by("_v", "_k").alias("_lv")))
    joined = df.join(small_side(lookup, check=map_df), F.lower(F.col(key_col)) == F.col("_lk"), "left")
    value = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return joined.withColumn(out_col, value).drop("_lk", "_lv")


def nonempty_split(text: Column, sep_regex: str) -> Column:
    """Split and drop empty tokens (adjacent separators act as one)."""
    return F.filter(F.split(text, sep_regex), lambda x: x != F.lit(""))


def split_list(df: DataFrame, col: str, out_col: str | None = None, sep: str = ",") -> DataFrame:
    """Comma list → array of its non-empty items."""
    return df.withColumn(out_col or col, nonempty_split(F.col(col), re.escape(sep)))


# An item (text between commas) with two non-empty ``=``-separated tokens:
# the match may only start at an item start, and swallows the rest of the item.
_GOOD_ITEM = r"(?<![^,])=*([^=,]+)=+([^=,]+)[^,]*"


def parse_pairs(df: DataFrame, col: str, out_col: str = "pairs", route_col: str = "route") -> DataFrame:
    """``k=v,k=v`` → map<string,string>.

    Items and ``=``-separated tokens are split with empty tokens dropped;
    the first token is the key, the second the value (later ones ignored), the
    last duplicate key wins. An item with fewer than two tokens makes the row
    ``failure`` with a null map; other rows are ``success``; a null text has no
    items and gives an empty map.

    Two native regex scans per text (non-empty items; well-formed items with
    their key and value) and one filter that keeps each key's last entry.
    """
    text = F.col(col)
    n_items = F.size(F.regexp_extract_all(text, F.lit("[^,]+"), 0))
    keys = F.regexp_extract_all(text, F.lit(_GOOD_ITEM), 1)
    values = F.regexp_extract_all(text, F.lit(_GOOD_ITEM), 2)
    staged = spread(df).withColumn("_k", keys).withColumn("_v", values).withColumn("_bad", F.size("_k") < n_items)
    last = F.filter(F.arrays_zip(F.col("_k").alias("key"), F.col("_v").alias("value")),
                    lambda e, i: i == F.size("_k") - F.array_position(F.reverse(F.col("_k")), e["key"]))
    empty = F.create_map().cast("map<string,string>")
    pairs = F.when(text.isNull(), empty).when(~F.col("_bad"), F.map_from_entries(last))
    return (staged.withColumn(out_col, pairs)
            .withColumn(route_col, F.when(text.isNotNull() & F.col("_bad"), F.lit("failure"))
                        .otherwise(F.lit("success")))
            .drop("_k", "_v", "_bad"))


def metric_json(df: DataFrame, object_col: str, value_col: str, agg: str = "max",
                attribute: str = "Max", out_col: str = "metric") -> DataFrame:
    """One ``{object: {attribute: "value"}}`` document per object (value as text)."""
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "count": F.count}[agg]
    per = df.groupBy(object_col).agg(fn(value_col).alias("_v"))
    doc = F.to_json(F.create_map(F.col(object_col), F.create_map(F.lit(attribute), F.col("_v").cast("string"))))
    return per.select(F.col(object_col), F.col("_v").alias(agg + "_value"), doc.alias(out_col))
