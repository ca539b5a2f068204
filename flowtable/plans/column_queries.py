"""Registered projection / enrichment queries over events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.columns import (lookup_enrich, metric_json, parse_pairs, put_content, rewrite_extension,
                                         split_list)
from flowtable.plans.common import PAGE_FILES_SQL, page_files
from flowtable.plans.registry import query
from flowtable.sources.tables import load

TEMPLATE = "user ${user_id} did ${event_type} (${value}) #${event_id}"


@query("put_content", oracle="""
SELECT event_id, 'user ' || user_id || ' did ' || event_type || ' (' || CAST(value AS VARCHAR) || ') #' || event_id
       AS content
FROM events
""")
def q_put_content(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return put_content(events, TEMPLATE).select("event_id", "content")


@query("rewrite_extension", oracle=f"""
WITH {PAGE_FILES_SQL}
SELECT page_id, name,
       CASE WHEN contains(name, '.') THEN regexp_replace(name, '\\.[^.]*$', '.jpg') ELSE name END AS new_name
FROM page_files
""")
def q_rewrite_extension(spark, sf_dir):
    files = page_files(spark, sf_dir).select("page_id", "name")
    return rewrite_extension(files, "name", ".jpg", out_col="new_name")


# Per event type weights (upper-case keys, matched ignoring case).
EVENT_WEIGHTS = [("CLICK", "1.5"), ("VIEW", "0.5"), ("PURCHASE", "10"), ("SIGNUP", "3")]


@query("lookup_enrich", oracle="""
WITH m(k, v) AS (VALUES ('CLICK', '1.5'), ('VIEW', '0.5'), ('PURCHASE', '10'), ('SIGNUP', '3'))
SELECT event_id, event_type, coalesce(m.v, '0.0') AS weight
FROM events LEFT JOIN m ON lower(event_type) = lower(m.k)
""")
def q_lookup_enrich(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "event_type")
    weights = spark.createDataFrame(EVENT_WEIGHTS, "key string, value string")
    return lookup_enrich(events, "event_type", weights, out_col="weight", default="0.0")


def _config_col():
    """A ``k=v`` config text per event: an empty item, a repeated key (the
    later, upper-case one wins) and, for large values, an item without ``=``."""
    return F.concat(
        F.lit("type="), F.col("event_type"), F.lit(",user="), F.col("user_id").cast("string"), F.lit(",,k="),
        F.get_json_object("props", "$.k"), F.lit(",type="), F.upper("event_type"),
        F.when(F.col("value") > 400, F.lit(",broken")).otherwise(F.lit("")))


_CONFIG_SQL = """'type=' || event_type || ',user=' || user_id || ',,k=' || json_extract_string(props, '$.k')
  || ',type=' || upper(event_type) || CASE WHEN value > 400 THEN ',broken' ELSE '' END"""


@query("parse_pairs", oracle=f"""
WITH s AS (SELECT event_id, list_filter(string_split({_CONFIG_SQL}, ','), lambda x: x <> '') AS items FROM events),
it AS (SELECT event_id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM s),
tk AS (SELECT event_id, pos, list_filter(string_split(item, '='), lambda x: x <> '') AS toks FROM it),
bad AS (SELECT event_id, bool_or(len(toks) < 2) AS b FROM tk GROUP BY event_id),
ranked AS (
  SELECT event_id, toks[1] AS key, toks[2] AS value,
         row_number() OVER (PARTITION BY event_id, toks[1] ORDER BY pos DESC) AS rn
  FROM tk
)
SELECT r.event_id, r.key, r.value, 'success' AS route FROM ranked r JOIN bad USING (event_id)
WHERE rn = 1 AND NOT bad.b
UNION ALL
SELECT event_id, NULL, NULL, 'failure' FROM bad WHERE b
""")
def q_parse_pairs(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", _config_col().alias("config"))
    parsed = parse_pairs(events, "config")
    return parsed.select("event_id", F.explode_outer("pairs").alias("key", "value"), "route")


@query("split_list", oracle=f"""
WITH s AS (SELECT event_id, list_filter(string_split({_CONFIG_SQL}, ','), lambda x: x <> '') AS items FROM events)
SELECT event_id, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS pos, unnest(items) AS item FROM s
""")
def q_split_list(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", _config_col().alias("config"))
    items = split_list(events, "config", "items")
    return items.select("event_id", F.posexplode("items").alias("pos", "item"))


@query("metric_json", oracle="""
SELECT event_type, max(value) AS max_value,
       '{"' || event_type || '":{"Max":"' || CAST(max(value) AS VARCHAR) || '"}}' AS metric
FROM events GROUP BY event_type
""")
def q_metric_json(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return metric_json(events, "event_type", "value", agg="max", attribute="Max")
