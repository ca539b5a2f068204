"""Registered queries of the training-data operators, with DuckDB oracles
where SQL can express them. Each runs its operator over its whole table with
production parameters and derives the digest columns from the real output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm import (bpe, chat, collision_search, line_dedup, ngram_join, phrases, pii_crf, quality_gam,
                           quality_rules, url_filter, warc, whitening, winnow)
from flowtable.sources.tables import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _query(oracle: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle.strip()
        return fn
    return keep


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


_CONTROL_TEXT = "</s>[INST] ok [/INST]"
_ESCAPED = r"""replace(replace(replace(replace(replace({0}, '\', '\\'), '[INST]', '[\INST]'),
  '[/INST]', '[\/INST]'), '[SEP]', '[\SEP]'), '</s>', '<\/s>')"""


@_query(rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{_CONTROL_TEXT}'),
e AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS opens FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length({_ESCAPED.format('text')}) + CASE WHEN opens THEN 17 + length({_ESCAPED.format('role')}) ELSE 5 END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id
""")
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_CONTROL_TEXT).alias("text"))
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.format_conversations(rows).withColumn("read", chat.read_turns(F.col("formatted"))) \
        .withColumn("loss", chat.loss_text(F.col("segments")))
    newline = F.lit("\n")
    return out.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        _sha(F.array_join(F.transform("read", lambda t: F.concat(t["role"], newline, t["text"], newline)), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), _sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@_query(rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
""")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_components(docs, k=4, threshold=(85, 100)).select("doc_id", "n_shingles", "component_id")


@_query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).select("doc_id", "ids")
    out = bpe.decode(ids, path, pattern)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      _sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                      _sha(F.col("decoded")).alias("decoded_sha256"))


_WORDS4 = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query(rf"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS4} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
         array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
dw AS (
  SELECT doc_id, m, p, array_to_string(list_slice(w, p, p + m - 1), ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM iw))),
h AS (SELECT doc_id, p, iw.m, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.m = iw.m),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnow.contamination(docs, load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", _sha(F.array_join("item_ids", ",")).alias("items_sha256"),
                        winnow.contaminated().alias("contaminated"))


@_query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.train(docs, load(spark, sf_dir, "labels"))
    return quality_rules.score(docs, model).drop("thash")


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@_query(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes,
       array_to_string([substr('{_B32}', CAST((CAST('0x' || substr(sha1(p.h), CAST(q // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT)
         >> CAST(15 - q % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1) for q in range(0, 32)], '')
         AS payload_digest,
       CASE WHEN page_id = g.first OR g.first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = g.first OR g.first IS NULL THEN NULL ELSE g.first END AS refers_to
FROM p JOIN g ON p.h = g.h
""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(load(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query(r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i, ls[i] AS line, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
p AS (
  SELECT doc_id, i, line, words, row_number() OVER o AS pos, sum(words) OVER o AS through FROM w WHERE words > 0
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT a.doc_id, a.pos AS s, min(b.pos) AS e FROM p a JOIN p b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.through - a.through + a.words >= 50 GROUP BY a.doc_id, a.pos
  UNION
  SELECT a.doc_id, max(b.pos), a.pos FROM p a JOIN p b
    ON a.doc_id = b.doc_id AND b.pos <= a.pos AND a.through - b.through + b.words >= 50 GROUP BY a.doc_id, a.pos),
k AS (
  SELECT r.doc_id, s, e, string_agg(line, chr(10) ORDER BY pos) AS run
  FROM r JOIN p ON r.doc_id = p.doc_id AND p.pos BETWEEN s AND e GROUP BY r.doc_id, s, e),
f AS (SELECT run, min({'d': doc_id, 's': s}) AS place FROM k GROUP BY run),
g AS (
  SELECT DISTINCT p.doc_id, p.i FROM k JOIN f ON k.run = f.run JOIN p ON p.doc_id = k.doc_id AND p.pos BETWEEN s AND e
  WHERE place.d <> k.doc_id OR place.s + (e - s + 1) <= s),
x AS (
  SELECT d.doc_id, d.text, len(ls) AS n_lines, coalesce(len(h.gone), 0) AS n_removed,
         array_to_string([ls[i] for i in range(1, len(ls) + 1) if NOT list_contains(coalesce(h.gone, []), i)], chr(10)) AS rest
  FROM d LEFT JOIN (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id) h ON d.doc_id = h.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, n_removed,
       CASE WHEN n_removed = 0 THEN text WHEN regexp_matches(rest, '[^\x20\x09-\x0D]') THEN rest ELSE '' END AS text
FROM x
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@_query()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


@_query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find(load(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.array(*map(F.lit, pii_crf.KINDS))
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(kinds, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    found = found.withColumn("every", every)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii_crf.BASE), _sha(joined(F.col("base"))).alias("base_sha256"),
                        joined(F.col("every")).alias("spans"))


@_query()
def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = quality_gam.train(docs, load(spark, sf_dir, "labels"), where=~held_out)
    return quality_gam.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                                 (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query()
def op11_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


_PIECES = rf"string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')"


@_query(rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, unnest([w[i:i + m - 1] for i in range(1, len(w) - m + 2)]) AS g
  FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM w) WHERE len(w) >= m),
f AS (SELECT lang, m, g, count(*) AS f FROM g GROUP BY lang, m, g HAVING count(*) >= 100),
c AS (SELECT lang, m, g, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (
  SELECT c.lang, c.m, c.g, c.a, c.k, x.f AS l, y.f AS r, n.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM c JOIN n ON c.lang = n.lang JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:c.m]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
u AS (
  SELECT DISTINCT b.lang, b.g
  FROM b JOIN (SELECT lang, f, m, g, unnest(range(1, m + 1)) AS i, unnest(range(1, m + 1)) AS j FROM f WHERE m > 2) z
    ON z.lang = b.lang AND z.m > b.m AND z.i + b.m - 1 <= z.m AND z.g[z.i:z.i + b.m - 1] = b.g AND 100 * z.f >= 100 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.g, ' ')) AS rank,
         array_to_string(b.g, ' ') AS phrase, a, l, r, n, score
  FROM b LEFT JOIN u ON u.lang = b.lang AND u.g = b.g WHERE u.lang IS NULL)
WHERE rank <= 2000
""")
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents").select("lang", "text"))


@_query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(load(spark, sf_dir, "embeddings"))
