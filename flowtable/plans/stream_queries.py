"""Registered stream and archive queries. Each writes its inputs (derived
from the driver tables) under the shared checkpoint folder, runs the stream
with ``availableNow`` to completion and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtable.operators.extract import nth_match
from flowtable.plans.common import ORDER_FILES_SQL, order_files
from flowtable.plans.registry import query
from flowtable.plans.text_queries import NTH_K, NTH_REGEX
from flowtable.session import cluster_cores, scratch_path
from flowtable.sources.archives import first_value_per_archive, write_zip_archives, zip_entries
from flowtable.sources.tables import load
from flowtable.streaming.delay import delay_stream
from flowtable.streaming.listing import announce, emitted_so_far, listing_stream
from flowtable.streaming.records import drain_records
from flowtable.streaming.topic import drain_available, publish, topic_drain

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("topic_drain", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_topic_drain(spark, sf_dir):
    base = scratch_path(spark, "topic")
    publish(load(spark, sf_dir, "events"), f"{base}/topic", records_per_file=5000)
    stream = topic_drain(spark, f"{base}/topic", EVENT_SCHEMA, max_files_per_trigger=10)
    return drain_available(stream, f"{base}/sink", f"{base}/checkpoint")


SUPPLIER_SCHEMA = "s_suppkey bigint, s_name string, s_nationkey bigint"


@query("topic_records", oracle="SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier")
def q_topic_records(spark, sf_dir):
    """Suppliers as a topic of uneven files, a bounded number of records a
    trigger, whatever the files hold; lanes of files are drained side by side."""
    base = scratch_path(spark, "records")
    publish(load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("long").alias("s_nationkey")),
            f"{base}/topic", records_per_file=137)
    return drain_records(spark, f"{base}/topic", SUPPLIER_SCHEMA, base, max_records_per_trigger=100)


GATE_DELAY_MS = 24 * 3600 * 1000


@query("delay_stream", oracle=f"""
WITH e AS (SELECT *, epoch_us(ts) // 1000 AS delay_timestamp FROM events)
SELECT *, 'delay' AS route FROM e
UNION ALL
SELECT *, 'ready' FROM e WHERE (SELECT max(delay_timestamp) FROM e) - delay_timestamp > {GATE_DELAY_MS}
""")
def q_delay_stream(spark, sf_dir):
    base = scratch_path(spark, "delay")
    publish(load(spark, sf_dir, "events"), f"{base}/topic", records_per_file=10000)
    # The state store keeps the partition count the query starts with; size it
    # to the cluster's cores in a sibling session instead of the shuffle default.
    stateful = spark.newSession()
    stateful.conf.set("spark.sql.shuffle.partitions", str(cluster_cores(spark)))
    stateful.conf.set("spark.sql.session.timeZone", "UTC")
    # the watermark moves with each trigger; records whose delay it passes come out in the next one
    stream = topic_drain(stateful, f"{base}/topic", EVENT_SCHEMA, max_files_per_trigger=10)
    gated = delay_stream(stream, delay_ms=GATE_DELAY_MS, event_time_col="ts")
    return drain_available(gated, f"{base}/sink", f"{base}/checkpoint")


@query("listing_stream", oracle=f"""
WITH {ORDER_FILES_SQL}
SELECT o_orderkey, mtime_ms FROM order_files WHERE mtime_ms < (SELECT max(mtime_ms) FROM order_files)
""")
def q_listing_stream(spark, sf_dir):
    base = scratch_path(spark, "listing")
    files = order_files(spark, sf_dir)
    # the folder as it grew: four snapshots, evenly spaced up to the newest file
    low, high = files.agg(F.min("mtime_ms"), F.max("mtime_ms")).first()
    dates = [] if low is None else sorted({low + (high - low) * i // 4 for i in range(1, 5)})
    for d in dates:
        files.where(F.col("mtime_ms") <= d).write.mode("overwrite").parquet(f"{base}/snapshots/as_of={d}")
    # two snapshots a manifest: one trigger each
    for i in range(0, len(dates), 2):
        announce(spark, f"{base}/manifests", [(f"{base}/snapshots/as_of={d}", d) for d in dates[i:i + 2]])
    q = listing_stream(spark, f"{base}/manifests", f"{base}/state", f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return emitted_so_far(spark, f"{base}/out").select("o_orderkey", "mtime_ms")


ARCHIVE_BUCKET = 100


@query("zip_entries", oracle=f"""
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
), docs AS (
  SELECT d.doc_id, d.source || '_' || CAST(d.doc_id // {ARCHIVE_BUCKET} AS VARCHAR) AS archive_key, hit.value
  FROM documents d LEFT JOIN hit ON d.doc_id = hit.doc_id
)
SELECT archive_key, bool_or(value IS NOT NULL) AS found,
       arg_min(value, doc_id) FILTER (WHERE value IS NOT NULL) AS value, 'success' AS route
FROM docs GROUP BY archive_key
""")
def q_zip_entries(spark, sf_dir):
    base = scratch_path(spark, "zips")
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "text",
        F.concat("source", F.lit("_"), F.floor(F.col("doc_id") / ARCHIVE_BUCKET).cast("string")).alias("archive_key"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("entry_name"))
    write_zip_archives(docs, base, "archive_key", "entry_name", "text", "doc_id")
    entries = zip_entries(spark, base).withColumnRenamed("route", "entry_route")
    matched = nth_match(entries, ["archive", "entry_index", "entry_route"], "content", NTH_REGEX, NTH_K)
    first = first_value_per_archive(matched)
    return first.select(F.regexp_extract("archive", r"([^/]+)\.zip$", 1).alias("archive_key"),
                        "found", "value", "route")
