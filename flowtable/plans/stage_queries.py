"""Registered Python-stage queries over documents: a user's batch function
and a load-once model, both with row-level failure routing."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd

from flowtable.operators.stages import model_batch_job, python_stage
from flowtable.plans.registry import query
from flowtable.sources.tables import load


def line_stats(pdf: pd.DataFrame) -> pd.DataFrame:
    """A user's batch function: number of lines and longest line per text."""
    lines = pdf["text"].str.split("\n")
    return pd.DataFrame({"n_lines": lines.str.len().astype("int64"),
                         "max_line_chars": lines.map(lambda ls: max(len(x) for x in ls)).astype("int64")})


@query("python_stage", oracle="""
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
       CAST(list_max(list_transform(string_split(text, chr(10)), lambda l: length(l))) AS BIGINT) AS max_line_chars,
       0 AS exit_code, 'success' AS route, CAST(NULL AS VARCHAR) AS error
FROM documents
""")
def q_python_stage(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return python_stage(docs, line_stats, "n_lines long, max_line_chars long", keep=["doc_id"])


# Our toy language model: stop words per language, tried in this order on ties.
STOPWORDS = [("en", ["the", "and", "of", "is", "that"]), ("fr", ["le", "la", "et", "les", "des"]),
             ("de", ["der", "und", "die", "das", "nicht"]), ("es", ["el", "y", "los", "las", "con"])]
_SW_VALUES = ", ".join(f"('{lang}', {i}, '{w}')" for i, (lang, ws) in enumerate(STOPWORDS) for w in ws)


_WORD = re.compile("[a-z]+")


def load_stopword_model():
    """Loader: runs once per task."""
    return {w: lang for lang, ws in STOPWORDS for w in ws}, [lang for lang, _ in STOPWORDS]


def predict_language(model, pdf: pd.DataFrame) -> pd.DataFrame:
    words, order = model
    preds, hits = [], []
    for text in pdf["text"]:
        seen = Counter(_WORD.findall(text.lower()))
        counts = dict.fromkeys(order, 0)
        for word, lang in words.items():
            counts[lang] += seen.get(word, 0)
        best = max(order, key=lambda lang: (counts[lang], -order.index(lang)))
        preds.append(best if counts[best] > 0 else None)
        hits.append(counts[best] if counts[best] > 0 else None)
    return pd.DataFrame({"lang_pred": preds, "hits": pd.array(hits, dtype="Int64")})


@query("model_batch_job", oracle=f"""
WITH sw(lang, ord, tok) AS (VALUES {_SW_VALUES}),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS tok FROM documents),
c AS (SELECT doc_id, lang, ord, count(*) AS n FROM t JOIN sw USING (tok) GROUP BY doc_id, lang, ord),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, ord) AS rn FROM c)
SELECT d.doc_id, b.lang AS lang_pred, b.n AS hits, 0 AS exit_code,
       CASE WHEN b.lang IS NULL THEN 'no results' ELSE 'success' END AS route, CAST(NULL AS VARCHAR) AS error
FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id AND b.rn = 1
""")
def q_model_batch_job(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return model_batch_job(docs, load_stopword_model, predict_language, "lang_pred string, hits long",
                           keep=["doc_id"])


# Records that a stage cannot handle: every 97th document (from 13 on).
BAD_SQL = "d.doc_id % 97 = 13"


def fussy_line_stats(pdf: pd.DataFrame) -> pd.DataFrame:
    bad = pdf.loc[pdf["doc_id"] % 97 == 13, "doc_id"]
    if len(bad):
        raise ValueError(f"bad record {bad.iloc[0]}: " + "x" * 1000)
    return line_stats(pdf)


@query("python_stage_failures", oracle=f"""
SELECT doc_id, CASE WHEN NOT {BAD_SQL} THEN CAST(len(string_split(text, chr(10))) AS BIGINT) END AS n_lines,
       CASE WHEN {BAD_SQL} THEN 1 ELSE 0 END AS exit_code, CASE WHEN {BAD_SQL} THEN 'failure' ELSE 'success' END AS route,
       CASE WHEN {BAD_SQL} THEN 'ValueError: bad record ' || doc_id || ': ' || repeat('x', 1000) END AS error
FROM documents d
""")
def q_python_stage_failures(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = python_stage(docs, fussy_line_stats, "n_lines long, max_line_chars long", keep=["doc_id"])
    return out.select("doc_id", "n_lines", "exit_code", "route", "error")


def fussy_language(model, pdf: pd.DataFrame) -> pd.DataFrame:
    if (pdf["doc_id"] % 97 == 13).any():
        raise LookupError("no model for this record")
    return predict_language(model, pdf)


@query("model_batch_job_failures", oracle=f"""
WITH sw(lang, ord, tok) AS (VALUES {_SW_VALUES}),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS tok FROM documents),
c AS (SELECT doc_id, lang, ord, count(*) AS n FROM t JOIN sw USING (tok) GROUP BY doc_id, lang, ord),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, ord) AS rn FROM c)
SELECT d.doc_id, CASE WHEN NOT {BAD_SQL} THEN b.lang END AS lang_pred,
       CASE WHEN {BAD_SQL} THEN 'failure' WHEN b.lang IS NULL THEN 'no results' ELSE 'success' END AS route,
       CASE WHEN {BAD_SQL} THEN 'LookupError: no model for this record' END AS error
FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id AND b.rn = 1
""")
def q_model_batch_job_failures(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = model_batch_job(docs, load_stopword_model, fussy_language, "lang_pred string, hits long", keep=["doc_id"])
    return out.select("doc_id", "lang_pred", "route", "error")
