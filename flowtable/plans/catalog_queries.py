"""Registered catalog/schema queries over the driver tables' schemas and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtable.operators.catalog import (build_extract_url, describe_objects, list_objects, object_summary,
                                         quota_usage, typed_ddl, typed_extract)
from flowtable.plans.registry import query
from flowtable.sources.tables import TABLES, load, load_many


def _counts_sql() -> str:
    parts = [f"SELECT '{t}' AS object, (SELECT count(*) FROM information_schema.columns "
             f"WHERE table_name = '{t}') AS n_fields, count(*) AS n_rows FROM {t}" for t in TABLES]
    return "\nUNION ALL ".join(parts)


@query("list_objects", oracle=_counts_sql())
def q_list_objects(spark, sf_dir):
    return list_objects(spark, sf_dir)


@query("object_summary", oracle="""
SELECT 'lineitem' AS object,
       (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS n_fields,
       (SELECT string_agg(column_name, ',' ORDER BY ordinal_position) FROM information_schema.columns
         WHERE table_name = 'lineitem') AS field_names,
       count(*) AS n_rows
FROM lineitem
""")
def q_object_summary(spark, sf_dir):
    return object_summary(load(spark, sf_dir, "lineitem"), "lineitem")


# DuckDB type names mapped to Spark's simple type strings for the tables' column types.
_DUCK_TO_SPARK = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
  ELSE lower(data_type) END"""


# (object, n_rows, name, n_null) of every column of every table, counted from its rows.
_NULLS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS object, n_rows, name, n_rows - n_set AS n_null FROM (SELECT count(*) AS n_rows FROM {t}), "
    f"(UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME name VALUE n_set)" for t in TABLES)


@query("describe_object", oracle=f"""
WITH nulls AS ({_NULLS})
SELECT table_name AS object, CAST(ordinal_position AS INTEGER) AS ordinal, column_name AS name,
       {_DUCK_TO_SPARK} AS type, n_rows, n_null, n_null > 0 AS nullable
FROM information_schema.columns JOIN nulls ON table_name = object AND column_name = name
""")
def q_describe_object(spark, sf_dir):
    return describe_objects(spark, load_many(spark, sf_dir, TABLES))


def _describe_type() -> Column:
    """Describe vocabulary for a table column: first column is the id; money
    columns (price, balance) are currency; other doubles double; arrays are
    picklists; strings string; anything else other."""
    name, kind = F.col("name"), F.col("type")
    return (F.when(F.col("ordinal") == 1, "id")
            .when(kind == "double", F.when(name.contains("price") | name.contains("bal"), "currency").otherwise("double"))
            .when(kind.startswith("array"), "picklist").when(kind == "string", "string").otherwise("other"))


def describe_documents(spark, sf_dir) -> DataFrame:
    """One describe document per table (``sobject_name``, ``fields_json``): the
    fields that have a value in some row, in order."""
    rows = describe_objects(spark, load_many(spark, sf_dir, TABLES)).where("n_null < n_rows")
    fields = F.sort_array(F.collect_list(F.struct("ordinal", "name", _describe_type().alias("type"))))
    return rows.groupBy(F.col("object").alias("sobject_name")).agg(F.to_json(F.transform(
        fields, lambda f: F.struct(f["name"].alias("name"), f["type"].alias("type")))).alias("fields_json"))


_DESCRIBE_COLS = f"""
nulls AS ({_NULLS}),
cols AS (
  SELECT table_name, column_name, ordinal_position AS pos,
         max(ordinal_position) OVER (PARTITION BY table_name) AS n,
         CASE WHEN ordinal_position = 1 THEN 'VARCHAR PRIMARY KEY'
              WHEN data_type = 'DOUBLE' THEN 'DOUBLE'
              WHEN data_type LIKE '%[]' THEN 'VARCHAR[]'
              ELSE 'VARCHAR' END AS ddl_type
  FROM information_schema.columns JOIN nulls ON table_name = object AND column_name = name WHERE n_null < n_rows
)"""


@query("typed_ddl", oracle=f"""
WITH {_DESCRIBE_COLS}
SELECT table_name AS sobject_name,
       'CREATE TABLE SALESFORCE.' || table_name || '(' ||
       string_agg(column_name || ' ' || CASE WHEN pos = n THEN 'VARCHAR' ELSE ddl_type END, ',' ORDER BY pos)
       || ')' AS ddl,
       'success' AS route
FROM cols GROUP BY table_name
""")
def q_typed_ddl(spark, sf_dir):
    return typed_ddl(describe_documents(spark, sf_dir))


EXTRACT_BASE = "https://instance.example.com"
LAST_SYNC = "2024-01-01T00:00:00Z"


@query("build_extract_url", oracle=f"""
WITH {_DESCRIBE_COLS}
SELECT table_name AS sobject_name,
       replace('{EXTRACT_BASE}/services/data/v36.0/queryAll/?q=SELECT ' ||
               string_agg(column_name, ',' ORDER BY pos) || ' FROM ' || table_name ||
               ' WHERE SYSTEMMODSTAMP > {LAST_SYNC} order by SYSTEMMODSTAMP asc', ' ', '+') AS url,
       'success' AS route
FROM cols GROUP BY table_name
""")
def q_build_extract_url(spark, sf_dir):
    # the extracted object is the described one: one URL per table
    return build_extract_url(describe_documents(spark, sf_dir), EXTRACT_BASE, F.col("sobject_name"), LAST_SYNC)


# Configured limits per event type (a parameter table; 'refund' is never used).
EVENT_LIMITS = [("click", 2500), ("view", 1500), ("purchase", 2000), ("refund", 100)]


@query("quota_usage", oracle="""
WITH limits(scope, max_allowed) AS (VALUES ('click', 2500), ('view', 1500), ('purchase', 2000), ('refund', 100)),
used AS (SELECT event_type AS scope, count(*) AS used FROM events GROUP BY event_type)
SELECT coalesce(l.scope, u.scope) AS scope, CAST(l.max_allowed AS BIGINT) AS max_allowed,
       CAST(coalesce(u.used, 0) AS BIGINT) AS used,
       CAST(l.max_allowed - coalesce(u.used, 0) AS BIGINT) AS remaining
FROM limits l FULL OUTER JOIN used u ON l.scope = u.scope
""")
def q_quota_usage(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    limits = spark.createDataFrame(EVENT_LIMITS, "scope string, max bigint")
    return quota_usage(events, "event_type", limits)


# Events as extracted JSON rows: some cut short, some with a text for a number, some without their id.
_EVENT_FIELDS = [("event_id", "id"), ("event_type", "string"), ("value", "double"), ("tags", "picklist")]
_JSON_SQL = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || CAST(value AS VARCHAR)
  || ',"tags":["a","' || user_id || '"],"more":1}'"""


@query("typed_extract", oracle=f"""
WITH e AS (SELECT *, {_JSON_SQL} AS j FROM events),
b AS (SELECT *, CASE event_id % 10 WHEN 3 THEN left(j, length(j) - 5) WHEN 7 THEN replace(j, '"value":', '"value":"x')
  WHEN 8 THEN replace(j, '"event_id":' || event_id || ',', '') ELSE j END AS c FROM e)
SELECT event_id AS key, CASE WHEN event_id % 10 NOT IN (3, 7, 8) THEN CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_id % 10 NOT IN (3, 7, 8) THEN event_type END AS event_type,
       CASE WHEN event_id % 10 NOT IN (3, 7, 8) THEN value END AS value,
       CASE WHEN event_id % 10 NOT IN (3, 7, 8) THEN 'a ' || user_id END AS tags,
       CASE WHEN event_id % 10 IN (3, 7, 8) THEN 'failure' ELSE 'success' END AS route,
       CASE WHEN event_id % 10 IN (3, 7, 8) THEN c END AS bad_record
FROM b
""")
def q_typed_extract(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    tags = F.array(F.lit("a"), F.col("user_id").cast("string"))
    json = F.to_json(F.struct("event_id", "event_type", "value", tags.alias("tags"), F.lit(1).alias("more")))
    last = F.col("event_id") % 10
    cut = F.when(last == 3, F.expr("left(j, length(j) - 5)")).when(last == 7, F.replace("j", F.lit('"value":'), F.lit('"value":"x'))) \
        .when(last == 8, F.replace("j", F.concat(F.lit('"event_id":'), F.col("event_id").cast("string"), F.lit(",")), F.lit(""))) \
        .otherwise(F.col("j"))
    content = events.withColumn("j", json).select(F.col("event_id").alias("key"), cut.alias("content"))
    return typed_extract(content, "content", _EVENT_FIELDS, keep=["key"]).withColumn("tags", F.array_join("tags", " "))
