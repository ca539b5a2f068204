"""Registered listing queries: inventories from pages, incremental listing
over orders, directory status over nation/customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.listing import (ListingState, directory_status, file_inventory, incremental_listing,
                                         name_suffix_inventory, scan_inventory)
from flowtable.plans.common import ORDER_FILES_SQL, PAGE_FILES_SQL, order_files, page_files, perms_sql
from flowtable.plans.registry import query
from flowtable.session import scratch_path
from flowtable.sources.files import write_files
from flowtable.sources.tables import load

NAME_REGEX = "[a-z0-9.]+"


@query("file_inventory", oracle=f"""
WITH {PAGE_FILES_SQL}
SELECT name AS filename, parent AS path, owner, "group", mtime_ms AS last_modified, length, replication,
       {perms_sql('mode')} AS permissions
FROM page_files
WHERE starts_with(path, '/')
  AND len(list_filter(string_split(substr(path, 2), '/'), lambda p: NOT regexp_full_match(p, '{NAME_REGEX}'))) = 0
""")
def q_file_inventory(spark, sf_dir):
    return file_inventory(page_files(spark, sf_dir), "/", recurse=True, name_regex=NAME_REGEX)


# Export layout: /<lang>/<page_id>.html, hidden ('.' prefix) for urls with a fragment.
LANG_DIRS = ["/en", "/fr", "/de", "/es"]


def _export_files(spark, sf_dir):
    files = page_files(spark, sf_dir)
    lang = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([a-z]+)", 1)
    name = F.concat(F.when(F.col("url").contains("#"), F.lit(".")).otherwise(F.lit("")),
                    F.col("page_id").cast("string"), F.lit(".html"))
    return files.withColumn("name", name).withColumn("parent", F.concat(F.lit("/"), lang)) \
                .withColumn("path", F.concat(F.col("parent"), F.lit("/"), F.col("name"))).drop("url")


@query("file_inventory_top", oracle=f"""
WITH {PAGE_FILES_SQL},
export AS (
  SELECT f.*, '/' || regexp_extract(p.url, '^[a-z]+://[^/?#]+/([a-z]+)', 1) AS dir,
         CASE WHEN contains(p.url, '#') THEN '.' ELSE '' END || CAST(f.page_id AS VARCHAR) || '.html' AS fname
  FROM page_files f JOIN pages p ON f.page_id = p.page_id
)
SELECT fname AS filename, dir AS path, owner, "group", mtime_ms AS last_modified, length, replication,
       {perms_sql('mode')} AS permissions
FROM export
WHERE dir IN ('/en', '/fr', '/de', '/es') AND regexp_full_match(fname, '[^.].*')
""")
def q_file_inventory_top(spark, sf_dir):
    # non-recursive listing of the four language folders with the default filter (no hidden names)
    return file_inventory(_export_files(spark, sf_dir), LANG_DIRS, recurse=False)


LISTED, EMITTED, AS_OF = 900000000000, 880000000000, 1000000000000


def _listing_sql(listed: int, emitted: int) -> str:
    return f"""
WITH {ORDER_FILES_SQL},
eligible AS (SELECT * FROM order_files WHERE NOT suffix(name, '_COPYING_')),
cand AS (SELECT * FROM eligible WHERE mtime_ms >= {listed} AND mtime_ms > {emitted}),
l AS (SELECT max(mtime_ms) AS m FROM cand)
SELECT cand.o_orderkey, cand.mtime_ms FROM cand, l
WHERE CASE WHEN l.m = {listed} THEN true ELSE cand.mtime_ms < l.m END
"""


@query("incremental_listing", oracle=_listing_sql(LISTED, EMITTED))
def q_incremental_listing(spark, sf_dir):
    files = order_files(spark, sf_dir)
    out, _ = incremental_listing(files, ListingState(LISTED, EMITTED), AS_OF)
    return out.select("o_orderkey", "mtime_ms")


# State caught up with the newest file: the held-back timestamp is released.
CAUGHT_LISTED, CAUGHT_EMITTED = 996624000000, 990000000000


@query("incremental_listing_caught_up", oracle=_listing_sql(CAUGHT_LISTED, CAUGHT_EMITTED))
def q_incremental_listing_caught_up(spark, sf_dir):
    files = order_files(spark, sf_dir)
    out, _ = incremental_listing(files, ListingState(CAUGHT_LISTED, CAUGHT_EMITTED), AS_OF)
    return out.select("o_orderkey", "mtime_ms")


@query("incremental_listing_state", oracle=f"""
WITH {ORDER_FILES_SQL},
eligible AS (SELECT * FROM order_files WHERE NOT suffix(name, '_COPYING_')),
cand AS (SELECT * FROM eligible WHERE mtime_ms >= {LISTED} AND mtime_ms > {EMITTED}),
l AS (SELECT max(mtime_ms) AS m FROM cand),
out AS (SELECT cand.* FROM cand, l WHERE CASE WHEN l.m = {LISTED} THEN true ELSE cand.mtime_ms < l.m END)
SELECT greatest({LISTED}, coalesce((SELECT max(mtime_ms) FROM eligible), {LISTED})) AS listed_ms,
       greatest({EMITTED}, coalesce((SELECT max(mtime_ms) FROM out), {EMITTED})) AS emitted_ms
""")
def q_incremental_listing_state(spark, sf_dir):
    files = order_files(spark, sf_dir)
    _, state = incremental_listing(files, ListingState(LISTED, EMITTED), AS_OF)
    return state


def _nation_dirs(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return (region.select(F.concat(F.lit("/"), "r_name").alias("path"), F.lit(True).alias("exists"))
            .unionByName(nation.select(F.concat(F.lit("/"), "n_name").alias("path"), F.lit(True).alias("exists")))
            .unionByName(nation.select(F.concat(F.lit("/"), "n_name", F.lit("/archive")).alias("path"),
                                       F.lit(False).alias("exists"))))


@query("directory_status", oracle="""
WITH dirs AS (
  SELECT '/' || r_name AS path, true AS "exists" FROM region
  UNION ALL SELECT '/' || n_name, true FROM nation
  UNION ALL SELECT '/' || n_name || '/archive', false FROM nation
), files AS (
  SELECT '/' || n_name AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey
), counts AS (SELECT parent, count(*) AS n FROM files GROUP BY parent)
SELECT path, CAST(coalesce(n, 0) AS BIGINT) AS n_children,
       CASE WHEN NOT "exists" THEN 'failure' WHEN coalesce(n, 0) = 0 THEN 'empty' ELSE 'not empty' END AS route
FROM dirs LEFT JOIN counts ON path = parent
""")
def q_directory_status(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer")
    # nation is a fixed 25-row dimension: broadcasting it is bounded at any scale
    files = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")) \
                    .select(F.concat(F.lit("/"), "n_name").alias("parent"))
    return directory_status(_nation_dirs(spark, sf_dir), files)


@query("name_suffix_inventory", oracle=f"""
WITH {PAGE_FILES_SQL}
SELECT DISTINCT name FROM (
  SELECT list_filter(string_split(name, '.'), lambda t: t <> '')[1] AS name FROM page_files WHERE suffix(name, '.html')
  UNION ALL SELECT 'index'
)
""")
def q_name_suffix_inventory(spark, sf_dir):
    return name_suffix_inventory(page_files(spark, sf_dir), "name", ".html", default="index")


# Real files: pages as <lang>/<page_id>.html (urls ending in .html) or .txt, with
# '_' or '.' in front for urls with a query or a fragment; languages that the
# filter leaves out are not read.
SCAN_REGEX = r"[a-z]{2}|_?[0-9]+\.html"


@query("scan_inventory", oracle=r"""
WITH f AS (
  SELECT regexp_extract(url, '^[a-z]+://[^/?#]+/([a-z]+)', 1) AS lang,
         CASE WHEN contains(url, '#') THEN '.' WHEN contains(url, '?') THEN '_' ELSE '' END || CAST(page_id AS VARCHAR)
           || CASE WHEN regexp_matches(url, '\.html([?#]|$)') THEN '.html' ELSE '.txt' END AS name,
         CAST(strlen(html) AS BIGINT) AS length
  FROM pages
)
SELECT name AS filename, '/' || lang AS path, length, 'rw-' AS owner_may, true AS has_owner FROM f
WHERE regexp_full_match(lang, '[a-z]{2}') AND regexp_full_match(name, '_?[0-9]+\.html')
""")
def q_scan_inventory(spark, sf_dir):
    base = scratch_path(spark, "pagefiles")
    pages = load(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([a-z]+)", 1)
    mark = F.when(F.col("url").contains("#"), ".").when(F.col("url").contains("?"), "_").otherwise("")
    ext = F.when(F.col("url").rlike(r"\.html([?#]|$)"), F.lit(".html")).otherwise(F.lit(".txt"))
    rel = F.concat(lang, F.lit("/"), mark, F.col("page_id").cast("string"), ext)
    write_files(pages.select(rel.alias("rel"), "html"), base, "rel", "html")
    listed = scan_inventory(spark, base, name_regex=SCAN_REGEX)
    inv = file_inventory(listed, base, recurse=True, name_regex=SCAN_REGEX)
    # report the parent relative to the scanned root
    return inv.select("filename", F.substring("path", len(base) + 1, 1 << 20).alias("path"), "length",
                      F.substring("permissions", 1, 3).alias("owner_may"), F.col("owner").isNotNull().alias("has_owner"))
