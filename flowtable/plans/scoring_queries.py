"""Registered scoring and transcript queries over embeddings, documents,
conversations, plus the batch delay gate over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.gate import delay_gate
from flowtable.operators.scoring import assemble_transcript, label_top1, sentiment, top_k_annotations, utterances
from flowtable.plans.registry import query
from flowtable.sources.tables import load

LABELS = [f"dim{i}" for i in range(64)]


@query("label_top1", oracle="""
WITH b AS (SELECT vec_id, embedding AS e, list_position(embedding, list_max(embedding)) AS idx FROM embeddings)
SELECT vec_id, CAST(idx - 1 AS INTEGER) AS label_index, 'dim' || (idx - 1) AS label_name,
       round(CAST(e[idx] AS DOUBLE) * 100.0, 4) AS label_score
FROM b
""")
def q_label_top1(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return label_top1(emb, "embedding", LABELS).select("vec_id", "label_index", "label_name", "label_score")


@query("top_k_annotations", oracle="""
WITH a AS (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS score
  FROM embeddings
), f AS (SELECT *, CASE WHEN pos < 32 THEN 'low' ELSE 'high' END AS feature FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id, feature ORDER BY score DESC, pos) AS rank FROM f)
SELECT vec_id, feature, pos, CAST(score AS DOUBLE) AS score, CAST(rank AS INTEGER) AS rank, 'success' AS route
FROM r WHERE rank <= 10
UNION ALL
SELECT vec_id, NULL, NULL, NULL, NULL, 'no detections' FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM r)
""")
def q_top_k_annotations(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ann = emb.select("vec_id", F.posexplode("embedding").alias("pos", "score")).select(
        "vec_id", "pos", F.col("score").cast("double").alias("score"),
        F.when(F.col("pos") < 32, "low").otherwise("high").alias("feature"))
    top = top_k_annotations(ann, ["vec_id"], "feature", "score", features=["low", "high"], k=10,
                            tie_cols=["pos"], keys_df=emb.select("vec_id"))
    return top.select("vec_id", "feature", "pos", "score", F.col("rank").cast("int").alias("rank"), "route")


# Lexicon: frequent words of the corpus with weights that are multiples of 1/8,
# so sums are exact in any order.
LEXICON = [("the", 0.125), ("and", 0.25), ("of", -0.125), ("is", 0.5), ("that", -0.25), ("with", 0.375),
           ("et", 0.25), ("la", -0.375), ("le", 0.125), ("der", -0.5), ("und", 0.75), ("el", -0.25), ("y", 0.125)]
_LEX_VALUES = ", ".join(f"('{t}', CAST({w} AS DOUBLE))" for t, w in LEXICON)


@query("sentiment", oracle=f"""
WITH lex(tok, w) AS (VALUES {_LEX_VALUES}),
t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '')) AS tok
      FROM documents),
h AS (SELECT doc_id, sum(w) AS s, sum(abs(w)) AS m, count(*) AS n FROM t JOIN lex USING (tok) GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN coalesce(h.n, 0) > 0 THEN round(h.s / h.m, 6) END AS score,
       CASE WHEN coalesce(h.n, 0) > 0 THEN round(h.m, 6) END AS magnitude,
       coalesce(h.n, 0) AS n_hits,
       CASE WHEN coalesce(h.n, 0) > 0 THEN 'success' ELSE 'no results' END AS route
FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id
""")
def q_sentiment(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = spark.createDataFrame(LEXICON, "token string, weight double")
    return sentiment(docs, "doc_id", "text", lexicon)


@query("utterances", oracle="""
SELECT conv_id, turn, text AS transcript, coalesce(strlen(text), 0) AS n_bytes,
       coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS n_words,
       CASE WHEN coalesce(regexp_matches(text, '[^ \t\n\x0B\f\r]'), false) THEN 'success' ELSE 'no results' END AS route
FROM conversations
""")
def q_utterances(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    return utterances(conv, "conv_id", "turn", "text")


@query("assemble_transcript", oracle="""
SELECT conv_id, string_agg(coalesce(text, '') || ' ', '' ORDER BY turn) AS transcript, count(*) AS n_parts
FROM conversations GROUP BY conv_id
""")
def q_assemble_transcript(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    return assemble_transcript(conv, "conv_id", "turn", "text")


# Turns ordered by a text (role, then number): no bounds on the order values.
@query("assemble_transcript_by_text", oracle="""
WITH c AS (SELECT conv_id, role || '-' || lpad(CAST(turn AS VARCHAR), 8, '0') AS place, text FROM conversations)
SELECT conv_id, string_agg(coalesce(text, '') || ' ', '' ORDER BY place) AS transcript, count(*) AS n_parts
FROM c GROUP BY conv_id
""")
def q_assemble_transcript_by_text(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    place = F.concat("role", F.lit("-"), F.lpad(F.col("turn").cast("string"), 8, "0"))
    return assemble_transcript(conv.select("conv_id", place.alias("place"), "text"), "conv_id", "place", "text")


# Confidence of a recognised turn: here the share of its bytes that are letters.
@query("utterances_confidence", oracle="""
SELECT conv_id, turn, text AS transcript, coalesce(strlen(text), 0) AS n_bytes,
       coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS n_words,
       CASE WHEN coalesce(regexp_matches(text, '[^ \t\n\x0B\f\r]'), false) THEN 'success' ELSE 'no results' END AS route,
       CASE WHEN strlen(text) > 0 THEN CAST(len(regexp_extract_all(text, '[a-z]')) AS DOUBLE) / strlen(text) END AS confidence
FROM conversations
""")
def q_utterances_confidence(spark, sf_dir):
    letters = F.regexp_count("text", F.lit("[a-z]")).cast("double")
    share = F.when(F.octet_length("text") > 0, letters / F.octet_length("text"))
    conv = load(spark, sf_dir, "conversations").withColumn("share", share)
    return utterances(conv, "conv_id", "turn", "text", confidence_col="share")


GATE_AS_OF = 1705708800000  # 2024-01-20 00:00:00 UTC
GATE_DELAY = 5 * 24 * 3600 * 1000


@query("delay_gate", oracle=f"""
WITH s AS (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE (epoch_us(ts) // 1000) END AS stamp FROM events)
SELECT event_id, coalesce(stamp, {GATE_AS_OF}) AS delay_timestamp,
       CASE WHEN stamp IS NULL THEN 'delay' WHEN {GATE_AS_OF} - stamp > {GATE_DELAY} THEN 'ready' ELSE 'delay' END
         AS route
FROM s
""")
def q_delay_gate(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    # records not seen before ('view' events here) carry no stamp yet
    stamped = events.select("event_id", F.when(F.col("event_type") == "view", F.lit(None))
                            .otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("delay_timestamp"))
    return delay_gate(stamped, "delay_timestamp", GATE_AS_OF, GATE_DELAY)
