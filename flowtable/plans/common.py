"""Inputs derived from the driver tables, shared by several queries, with
the matching DuckDB SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.sources.tables import load

# pages.url as a file path: '/' + host + url path (query, fragment and trailing '/' removed).
_HOST = r"^[a-z]+://([^/?#]+)"
_UPATH = r"^[a-z]+://[^/?#]+([^?#]*)"


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inventory row per page (files schema of the listing operators)."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = F.concat(F.lit("/"), F.regexp_extract("url", _HOST, 1),
                    F.regexp_replace(F.regexp_extract("url", _UPATH, 1), "/+$", ""))
    return pages.withColumn("path", path).select(
        "page_id", "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("parent"),
        F.octet_length("html").cast("long").alias("length"),
        (F.lit(1704067200000) + F.col("page_id") * 60000).alias("mtime_ms"),
        F.regexp_extract("url", _HOST, 1).alias("owner"),
        F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([a-z]+)", 1).alias("group"),
        F.lit(3).alias("replication"),
        (F.col("page_id") % 512).cast("int").alias("mode"),
        F.lit(False).alias("is_dir"), "url")


PAGE_FILES_SQL = r"""
page_files AS (
  SELECT page_id, path,
         string_split(path, '/')[-1] AS name,
         regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent,
         CAST(strlen(html) AS BIGINT) AS length,
         1704067200000 + page_id * 60000 AS mtime_ms,
         regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS owner,
         regexp_extract(url, '^[a-z]+://[^/?#]+/([a-z]+)', 1) AS "group",
         3 AS replication,
         CAST(page_id % 512 AS INTEGER) AS mode
  FROM (SELECT page_id, url, html,
               '/' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)
                   || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') AS path
        FROM pages)
)"""


def perms_sql(mode: str) -> str:
    def bit(shift: int, b: int, ch: str) -> str:
        return f"CASE WHEN (({mode} >> {shift}) & {b}) <> 0 THEN '{ch}' ELSE '-' END"
    return " || ".join(bit(s, b, ch) for s in (6, 3, 0) for b, ch in ((4, "r"), (2, "w"), (1, "x")))


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as files: name = order key, mtime = order date in epoch ms (UTC)."""
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("name"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("mtime_ms"))


ORDER_FILES_SQL = """
order_files AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS name, (epoch_us(o_orderdate) // 1000) AS mtime_ms FROM orders
)"""
