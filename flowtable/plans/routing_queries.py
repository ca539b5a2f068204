"""Registered routing queries: route split, format detection, purges, scope
clears, capped actions and busy queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.records import route_split
from flowtable.operators.routing import (busy_nodes, capped_actions, clear_scope, detect_format, purge_keys,
                                         purge_report)
from flowtable.plans.registry import query
from flowtable.session import small_side
from flowtable.sources.tables import load


@query("route_split", oracle="""
SELECT d.doc_id,
       CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'high_quality'
            WHEN l.doc_id IS NULL THEN 'unlabeled' ELSE 'low_quality' END AS route
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_route_split(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id")
    labels = load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_doc_id")
    joined = docs.join(small_side(labels), F.col("doc_id") == F.col("l_doc_id"), "left")
    routed = route_split(joined, [("toxic", F.col("toxic") == 1), ("high_quality", F.col("quality") == 1),
                                  ("unlabeled", F.col("l_doc_id").isNull())], default="low_quality")
    return routed.select("doc_id", "route")


_MAGIC_SQL = """CASE
  WHEN starts_with(h, '49492A00') OR starts_with(h, '4D4D002A') THEN 'image/tiff'
  WHEN starts_with(h, 'FFD8FF') THEN 'image/jpeg'
  WHEN starts_with(h, '47494638') THEN 'image/gif'
  WHEN starts_with(h, '89504E470D0A1A0A') THEN 'image/png'
  WHEN starts_with(h, '424D') THEN 'image/bmp'
  WHEN starts_with(h, '25504446') THEN 'application/pdf' END"""


# Contents with each accepted magic prefix, one that ends too early, and plain text.
_HEADS = ["49492A00", "4D4D002A", "FFD8FF", "47494638", "89504E470D0A1A0A", "424D", "25504446", "89504E47", ""]
_HEAD_SQL = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(_HEADS)) + " END"


@query("detect_format", oracle=f"""
WITH x AS (SELECT doc_id, left({_HEAD_SQL} || upper(hex(encode(left(text, 8)))), 16) AS h FROM documents),
m AS (SELECT doc_id, {_MAGIC_SQL} AS mime FROM x)
SELECT doc_id, mime, CASE WHEN mime IS NULL THEN 'failure' ELSE 'success' END AS route,
       CASE WHEN mime IS NULL THEN 'unsupported image format' END AS reason
FROM m
""")
def q_detect_format(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    head = F.lit("")
    for i, h in enumerate(_HEADS):
        head = F.when(F.col("doc_id") % 9 == i, F.lit(h)).otherwise(head)
    content = F.concat(F.unhex(head), F.encode("text", "UTF-8"))
    return detect_format(docs.select("doc_id", content.alias("content")), "content").select("doc_id", "mime", "route", "reason")


@query("purge_keys", oracle="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)
""")
def q_purge_keys(spark, sf_dir):
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    tombs = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    return purge_keys(lineitem, tombs, "l_orderkey", "o_orderkey")


@query("purge_report", oracle="""
SELECT o_orderkey,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) THEN 'success' ELSE 'failure' END
       AS route
FROM orders WHERE o_orderstatus = 'F'
""")
def q_purge_report(spark, sf_dir):
    lineitem = load(spark, sf_dir, "lineitem").select("l_orderkey")
    tombs = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    return purge_report(lineitem, tombs, "l_orderkey", "o_orderkey")


# Scopes a user asks to clear (nation names; one that does not exist).
CLEAR_SCOPES = ["NATION_3", "NATION_7", "NATION_11", "ATLANTIS"]
_CLEAR_VALUES = ", ".join(f"('{s}')" for s in CLEAR_SCOPES)


def _scopes(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    req = spark.createDataFrame([(s,) for s in CLEAR_SCOPES], "scope string")
    known = nation.select(F.col("n_name").alias("_n"), F.lit(True).alias("exists"))
    return req.join(F.broadcast(known), F.col("scope") == F.col("_n"), "left").select("scope", "exists")


def _customers_by_nation(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a fixed 25-row dimension
    return customer.join(F.broadcast(nation.select("n_nationkey", "n_name")),
                         F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("clear_scope", oracle=f"""
WITH req(scope) AS (VALUES {_CLEAR_VALUES}),
c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
r AS (SELECT scope, n_name IS NOT NULL AS ex FROM req LEFT JOIN (SELECT DISTINCT n_name FROM nation) ON scope = n_name)
SELECT r.scope, CAST(CASE WHEN ex THEN coalesce(c.n, 0) ELSE 0 END AS BIGINT) AS n_removed,
       CASE WHEN NOT ex THEN 'failure' WHEN coalesce(c.n, 0) = 0 THEN 'empty' ELSE 'success' END AS route
FROM r LEFT JOIN c ON r.scope = c.n_name
""")
def q_clear_scope(spark, sf_dir):
    report, _ = clear_scope(_scopes(spark, sf_dir), _customers_by_nation(spark, sf_dir), "n_name")
    return report


@query("clear_scope_survivors", oracle=f"""
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT IN (SELECT scope FROM (VALUES {_CLEAR_VALUES}) t(scope))
""")
def q_clear_scope_survivors(spark, sf_dir):
    _, survivors = clear_scope(_scopes(spark, sf_dir), _customers_by_nation(spark, sf_dir), "n_name")
    return survivors.select("c_custkey", "n_name")


@query("capped_actions", oracle="""
SELECT event_id,
       CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= 90 THEN 'act' ELSE 'no action taken' END AS route
FROM events
""")
def q_capped_actions(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    return capped_actions(events, ["ts", "event_id"], maximum=100, already=10).select("event_id", "route")


@query("capped_actions_per_key", oracle="""
SELECT event_id, user_id,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 5 THEN 'act'
            ELSE 'no action taken' END AS route
FROM events
""")
def q_capped_actions_per_key(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return capped_actions(events, ["ts", "event_id"], maximum=5, key_col="user_id").select(
        "event_id", "user_id", "route")


def _group_tree(spark, sf_dir):
    region = load(spark, sf_dir, "region")
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer")
    return (region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("group_id"),
                          F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
            .unionByName(nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("group_id"),
                                       F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                                       F.col("n_name").alias("name")))
            .unionByName(customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("group_id"),
                                         F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"),
                                         F.col("c_name").alias("name"))))


def _queues(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer")
    per_customer = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("queued_count")).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("group_id"),
        F.lit("orders").alias("queue_name"), "queued_count")
    per_nation = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("queued_count")).select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("group_id"),
        F.lit("customers").alias("queue_name"), "queued_count")
    return per_customer.unionByName(per_nation)


@query("busy_nodes", oracle="""
WITH RECURSIVE grp(group_id, parent_id, name) AS (
  SELECT 'r' || r_regionkey, NULL, r_name FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer
), walk(group_id, path, depth) AS (
  SELECT group_id, name, 0 FROM grp WHERE parent_id IS NULL
  UNION ALL
  SELECT g.group_id, w.path || '/' || g.name, w.depth + 1 FROM grp g JOIN walk w ON g.parent_id = w.group_id
), queues AS (
  SELECT 'c' || o_custkey AS group_id, 'orders' AS queue_name, count(*) AS queued_count FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT 'n' || c_nationkey, 'customers', count(*) FROM customer GROUP BY c_nationkey
)
SELECT w.path, CAST(w.depth AS INTEGER) AS depth, q.queue_name AS queue, q.queued_count AS count
FROM queues q JOIN walk w ON q.group_id = w.group_id WHERE q.queued_count > 10
""")
def q_busy_nodes(spark, sf_dir):
    return busy_nodes(_group_tree(spark, sf_dir), _queues(spark, sf_dir), threshold=10)
