"""Incremental listing driven by a stream of listing snapshots.

Each snapshot is a full inventory (files schema) written to its own folder;
a small manifest JSON line ``{"snapshot": path, "as_of_ms": n, "source": text}``
announces it; ``source`` names the folder and filter that were listed, and the
watermarks start again where it changes.
The stream reads manifests (``foreachBatch``) and runs one listing per
snapshot in ``as_of_ms`` order. Outputs are written per snapshot (overwrite)
and the state history is appended in the order of commits, so a re-run of a
batch reads the same prior state and rewrites the same output, and a late
manifest starts from the newest state.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from flowtable.operators.listing import commit_state, listing_cutoff, next_state, state_before

MANIFEST_SCHEMA = "snapshot string, as_of_ms bigint, source string"


def announce(spark: SparkSession, manifest_dir: str, snapshot_path: str | list[tuple[str, int]],
             as_of_ms: int | None = None, source: str = "") -> None:
    """Write one manifest file announcing a snapshot folder, or several
    ``(folder, as_of_ms)`` snapshots at once (processed in time order), all of
    one ``source``."""
    rows = snapshot_path if isinstance(snapshot_path, list) else [(snapshot_path, as_of_ms)]
    spark.createDataFrame([(p, int(t), source) for p, t in rows], MANIFEST_SCHEMA).coalesce(1) \
         .write.mode("append").json(manifest_dir)


def listing_batch(spark: SparkSession, snapshot_path: str, as_of_ms: int, state_dir: str, output_dir: str,
                  min_age_ms: int | None = None, max_age_ms: int | None = None, source: str = "") -> None:
    """One listing run: output first, then the state row (at least once). A
    run of another ``source`` than the last one's starts from no state."""
    files = spark.read.parquet(snapshot_path)
    state, seq = state_before(spark, state_dir, as_of_ms, source)
    emitted, newest_eligible = listing_cutoff(files, state, as_of_ms, min_age_ms, max_age_ms)
    out_path = os.path.join(output_dir, f"as_of_ms={as_of_ms}")
    emitted.write.mode("overwrite").parquet(out_path)
    commit_state(next_state(spark, state, newest_eligible, spark.read.parquet(out_path)), state_dir, as_of_ms, seq, source)


def listing_stream(spark: SparkSession, manifest_dir: str, state_dir: str, output_dir: str, checkpoint: str,
                   min_age_ms: int | None = None, max_age_ms: int | None = None, snapshots_per_trigger: int = 1,
                   trigger_interval: str | None = None):
    """Start the stream; returns the started query. By default it processes
    what is announced and stops (``availableNow``); with ``trigger_interval``
    (e.g. ``"100 milliseconds"``, the minimum gap between two listings) it
    keeps running until stopped."""
    manifests = (spark.readStream.schema(MANIFEST_SCHEMA)
                 .option("maxFilesPerTrigger", int(snapshots_per_trigger)).json(manifest_dir))

    def each(batch: DataFrame, batch_id: int) -> None:
        # manifests are a few small rows per trigger (metadata, not data)
        for row in batch.orderBy("as_of_ms").collect():
            listing_batch(spark, row["snapshot"], int(row["as_of_ms"]), state_dir, output_dir,
                          min_age_ms, max_age_ms, row["source"] or "")

    writer = manifests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger_interval:
        return writer.trigger(processingTime=trigger_interval).start()
    return writer.trigger(availableNow=True).start()


def emitted_so_far(spark: SparkSession, output_dir: str) -> DataFrame:
    """Everything emitted by all runs (``as_of_ms`` names the run)."""
    return spark.read.parquet(output_dir)
