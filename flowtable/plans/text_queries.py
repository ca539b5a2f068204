"""Registered text-extraction queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.extract import extract_to, nested_detect, nth_match
from flowtable.plans.registry import query
from flowtable.sources.tables import load

# k-th match of a group pattern over the lines of every document.
NTH_REGEX = "th([a-z]+)"
NTH_K = 3


@query("nth_match", oracle=f"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS ord
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
), counted AS (
  SELECT doc_id, ord, line, len(regexp_extract_all(line, '{NTH_REGEX}', 0)) AS n FROM lines
), running AS (
  SELECT doc_id, ord, line, n,
         sum(n) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM counted
), hit AS (
  SELECT doc_id, regexp_extract_all(line, '{NTH_REGEX}', 1)[-1] AS value
  FROM running WHERE cum >= {NTH_K} AND cum - n < {NTH_K}
)
SELECT d.doc_id, hit.doc_id IS NOT NULL AS found, hit.value AS value, 'success' AS route
FROM documents d LEFT JOIN hit ON d.doc_id = hit.doc_id
""")
def q_nth_match(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return nth_match(docs, ["doc_id"], "text", NTH_REGEX, NTH_K, group_support=True)


# A group that may take no part in a match: then there is no value.
OPTIONAL_REGEX = "(s)?t"


@query("nth_match_optional", oracle=f"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS ord
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
), counted AS (
  SELECT doc_id, ord, line, len(regexp_extract_all(line, '{OPTIONAL_REGEX}', 0)) AS n FROM lines
), running AS (
  SELECT doc_id, ord, line, n,
         sum(n) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM counted
), hit AS (
  SELECT doc_id, regexp_extract_all(line, '{OPTIONAL_REGEX}', 1)[CAST({NTH_K} - (cum - n) AS BIGINT):] AS vals
  FROM running WHERE cum >= {NTH_K} AND cum - n < {NTH_K}
), ok AS (
  SELECT doc_id, vals[-1] AS value FROM hit WHERE len(list_filter(vals, lambda v: coalesce(v, '') = '')) = 0
)
SELECT d.doc_id, ok.doc_id IS NOT NULL AS found, ok.value AS value, 'success' AS route
FROM documents d LEFT JOIN ok ON d.doc_id = ok.doc_id
""")
def q_nth_match_optional(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return nth_match(docs, ["doc_id"], "text", OPTIONAL_REGEX, NTH_K, group_support=True)


# Definition tree: sentences (cropped: children see the last one), then words in it.
DETECTORS = [
    {"name": "sentence", "pattern": "[A-Z][^.!?]*[.!?]", "crop": "true",
     "children": [{"name": "word", "pattern": "th[a-z]+"}]},
]


@query("nested_detect", oracle="""
WITH s AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Z][^.!?]*[.!?]') AS sent FROM documents
), c AS (
  SELECT doc_id, sent, CASE WHEN len(sent) > 0 THEN sent[-1] ELSE text END AS crop FROM s
), w AS (
  SELECT doc_id, sent, regexp_extract_all(crop, 'th[a-z]+') AS words FROM c
), det AS (
  SELECT doc_id, 'sentence' AS path, 'sentence' AS name,
         CAST(generate_subscripts(sent, 1) AS INTEGER) AS ordinal, unnest(sent) AS content FROM w
  UNION ALL
  SELECT doc_id, 'sentence/word', 'word', CAST(generate_subscripts(words, 1) AS INTEGER), unnest(words) FROM w
)
SELECT doc_id, path, name, ordinal, content, 'success' AS route FROM det
UNION ALL
SELECT doc_id, NULL, NULL, NULL, NULL, 'no_object_detected' FROM w WHERE len(sent) = 0 AND len(words) = 0
""")
def q_nested_detect(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return nested_detect(docs, "doc_id", "text", DETECTORS)


PHONE = "[0-9]{3}-[0-9]{4}"


@query("extract_to", oracle=f"""
SELECT doc_id,
       CASE WHEN regexp_matches(text, '{PHONE}') THEN regexp_extract(text, '{PHONE}', 0) END AS phone,
       CASE WHEN regexp_matches(text, '{PHONE}') THEN 'success' ELSE 'failure' END AS route
FROM documents
""")
def q_extract_to(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return extract_to(docs, "text", PHONE, destination="attribute", attribute="phone").select("doc_id", "phone", "route")


@query("extract_to_content", oracle=f"""
SELECT doc_id,
       CASE WHEN regexp_matches(text, '{PHONE}') THEN regexp_extract(text, '{PHONE}', 0) ELSE text END AS text,
       CASE WHEN regexp_matches(text, '{PHONE}') THEN 'success' ELSE 'failure' END AS route
FROM documents
""")
def q_extract_to_content(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return extract_to(docs, "text", PHONE, destination="content")
