"""Registered object-sync queries over orders, events, customer, lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.records import as_json_content
from flowtable.operators.sync import (changed_ids, deleted_between, deleted_ids, incremental_extract, row_lookup,
                                      run_query)
from flowtable.plans.registry import query
from flowtable.sources.tables import load


@query("incremental_extract", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '2000-06-01 00:00:00' ORDER BY o_orderdate
""")
def q_incremental_extract(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return incremental_extract(orders, ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderdate",
                               "2000-06-01 00:00:00")


@query("changed_ids", oracle="""
SELECT user_id, max(ts) AS last_modified, count(*) AS n_changes FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
GROUP BY user_id
""")
def q_changed_ids(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return changed_ids(events, "user_id", "ts", "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query("deleted_ids", oracle="""
SELECT o_orderkey, max(o_orderdate) AS deleted_at FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
  AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
GROUP BY o_orderkey
""")
def q_deleted_ids(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return deleted_ids(orders, "o_orderkey", "o_orderdate", "o_orderstatus = 'F'",
                       "1997-01-01 00:00:00", "1999-01-01 00:00:00")


@query("deleted_between", oracle="""
SELECT DISTINCT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_orderstatus <> 'F' AND n.o_orderkey = o.o_orderkey)
""")
def q_deleted_between(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return deleted_between(orders, orders.where(F.col("o_orderstatus") != "F"), "o_orderkey")


@query("row_lookup", oracle="""
SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def q_row_lookup(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    ids = load(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return row_lookup(customer, "c_custkey", ids, "o_custkey")


RUN_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base_price,
       CAST(max(l_discount) AS DOUBLE) AS max_discount
FROM lineitem WHERE l_shipdate <= CAST(:cutoff AS TIMESTAMP_NTZ)
GROUP BY l_returnflag, l_linestatus
"""


@query("run_query", oracle=RUN_SQL.replace("CAST(:cutoff AS TIMESTAMP_NTZ)", "TIMESTAMP '1998-09-02 00:00:00'"))
def q_run_query(spark, sf_dir):
    lineitem = load(spark, sf_dir, "lineitem")
    return run_query(spark, RUN_SQL, args={"cutoff": "1998-09-02 00:00:00"}, views={"lineitem": lineitem})


CONTENT_SQL = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
       || '","value":' || CAST(value AS VARCHAR) || '}'"""


@query("content_sink", oracle=f"SELECT {CONTENT_SQL} AS content FROM events")
def q_content_sink(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return as_json_content(events, per="row")


# One JSON array per event type and range of 1000 event ids: a type may hold a
# large share of all events, so its arrays are split into bounded chunks.
CHUNK = 1000


@query("content_sink_grouped", oracle=f"""
SELECT event_type, event_id // {CHUNK} AS chunk,
       '[' || string_agg('{{"event_id":' || event_id || ',"value":' || CAST(value AS VARCHAR) || '}}', ','
                         ORDER BY event_id) || ']' AS content
FROM events GROUP BY event_type, event_id // {CHUNK}
""")
def q_content_sink_grouped(spark, sf_dir):
    events = load(spark, sf_dir, "events").select(
        "event_type", F.floor(F.col("event_id") / CHUNK).alias("chunk"), "event_id", "value")
    return as_json_content(events, per="group", key_cols=["event_type", "chunk"], order_cols=["event_id"])


# All events as one JSON array in pieces, read back element by element.
@query("content_sink_table", oracle="""
SELECT event_id, '{"event_id":' || event_id || ',"value":' || CAST(value AS VARCHAR) || '}' AS element FROM events
""")
def q_content_sink_table(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "value")
    parts = as_json_content(events, per="table", order_cols=["event_id"])
    # brackets and the commas at the seams go: each piece is an array again
    inner = F.concat(F.lit("["), F.regexp_replace("content", r"^\[|[\],]$", ""), F.lit("]"))
    elements = parts.select(F.explode(F.from_json(inner, "array<struct<event_id:bigint,value:double>>")).alias("e"))
    return elements.select("e.event_id", F.to_json("e").alias("element"))
