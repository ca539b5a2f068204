"""Delay gate on a stream: every record is passed on at once as ``delay`` and
again, whole, as ``ready`` once a delay has passed since it was first seen
(``transformWithState``: list state and timers in the RocksDB store)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowtable.streaming.topic import TS_OPTIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = T.StructType([T.StructField("record", T.StringType()), T.StructField("stamp", T.LongType()),
                       T.StructField("route", T.StringType())])
EMIT_ROWS = 20_000  # rows of an output frame


class _Gate(StatefulProcessor):
    """State of one (shard, slot): the waiting records of that slot of due
    times, and the earliest of their due times, for which a timer is set.
    Arrivals are appended unread; a slot is read only when its timer fires."""

    def __init__(self, delay: int, event_time: bool):
        self.delay, self.event_time = delay, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "record string, stamp long")
        self.earliest = handle.getValueState("earliest", "due long")

    def _now(self, timer_values) -> int:
        return timer_values.getCurrentWatermarkInMs() if self.event_time else timer_values.getCurrentProcessingTimeInMs()

    def _expect(self, due: int) -> None:
        """A timer for ``due`` unless one is set that fires no later."""
        known = self.earliest.get()[0] if self.earliest.exists() else None
        if known is None or due < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.earliest.update((due,))
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues):
        now, due = self._now(timerValues), None
        for frame in rows:
            frame = frame[frame["record"].notna()]
            if not len(frame):
                continue
            stamp = frame["stamp"].astype("int64")
            yield pd.DataFrame({"record": frame["record"], "stamp": stamp, "route": "delay"})
            late = now - stamp > self.delay
            if late.any():
                yield pd.DataFrame({"record": frame["record"][late], "stamp": stamp[late], "route": "ready"})
            kept = stamp[~late]
            if len(kept):
                self.waiting.appendList(list(zip(frame["record"][~late], kept.tolist())))
                first = int(kept.min()) + self.delay
                due = first if due is None else min(due, first)
        if due is not None:
            self._expect(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, rest, ready = self._now(timerValues), [], []
        for record, stamp in self.waiting.get():
            if now - stamp > self.delay:
                ready.append((record, stamp, "ready"))
                if len(ready) == EMIT_ROWS:
                    yield pd.DataFrame(ready, columns=["record", "stamp", "route"])
                    ready = []
            else:
                rest.append((record, stamp))
        if ready:
            yield pd.DataFrame(ready, columns=["record", "stamp", "route"])
        self.earliest.clear()
        if rest:
            self.waiting.put(rest)
            self._expect(max(min(s for _, s in rest) + self.delay, expiredTimerInfo.getExpiryTimeInMs() + 1))
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def delay_stream(df: DataFrame, delay_ms: int, event_time_col: str | None = None, watermark: str = "0 seconds",
                 stamp_col: str = "delay_timestamp", shards: int | None = None, slots: int = 4) -> DataFrame:
    """The records of ``df`` with their stamp (epoch ms) and ``route``: each
    record comes out once as ``delay`` when it is first seen, and once more as
    ``ready`` when its delay has strictly passed. A stamp that a record already
    carries in ``stamp_col`` is kept.

    The clock is processing time by default: the stamp is the time of the
    micro-batch (the same if it is replayed) and timers fire in later
    micro-batches (run it with a processing-time trigger, e.g.
    ``topic.start_drain``, since such timers always ask for another batch and
    ``availableNow`` would not finish). With ``event_time_col`` the record's
    time is its stamp and the watermark the clock: the output does not depend
    on the batches, and a record older than the watermark is no exception (it
    waits for nothing more and is ``ready`` at once). A null time is stamp 0.

    Waiting records are list state, kept per shard (a hash of the record) and
    per slot of due times, ``slots`` to a delay. A trigger appends its own
    records and reads only slots that are due; no slot is rewritten unless the
    clock stands inside it. A group holds one slot's share of one shard, so
    ``shards`` (the session's shuffle partitions by default) and ``slots``
    bound it whatever the keys are. The session is switched to the RocksDB
    state store, which keeps state on disk and in the checkpoint.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    names = [f.name for f in df.schema.fields if f.name != stamp_col]
    schema = df.select(*names).schema
    delay = int(delay_ms)
    width = max(1, delay // max(1, int(slots)))
    shards = int(shards or spark.conf.get("spark.sql.shuffle.partitions"))
    given = F.col(stamp_col).cast("long") if stamp_col in df.columns else F.lit(None).cast("long")
    record = F.to_json(F.struct(*names), TS_OPTIONS)
    at = F.col(event_time_col).cast("timestamp") if event_time_col else F.current_timestamp()
    stamp = F.coalesce(given, F.unix_millis(at), F.lit(0))
    rows = df.select(record.alias("record"), stamp.alias("stamp"), at.alias("at"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("record"), F.lit(shards))) \
        .withColumn("slot", F.floor((F.col("stamp") + delay) / width).cast("long"))
    if event_time_col:
        # Spark drops rows whose watermark column is late. So the time travels on a
        # copy of each record that only moves the watermark (and may be dropped);
        # the record itself has no value there. A zone-less time is read as UTC.
        none = F.lit(None)
        both = F.array(F.struct(none.cast("string").alias("record"), F.col("at").alias("clock")),
                       F.struct(F.col("record").alias("record"), none.cast("timestamp").alias("clock")))
        rows = rows.select("shard", "slot", "stamp", F.inline(both)).withWatermark("clock", watermark)
    else:
        rows = rows.drop("at")
    out = rows.groupBy("shard", "slot").transformWithStateInPandas(
        _Gate(delay, bool(event_time_col)), OUTPUT, "Append", "EventTime" if event_time_col else "ProcessingTime")
    return out.select(F.from_json("record", schema, TS_OPTIONS).alias("r"), "stamp", "route") \
        .select("r.*", F.col("stamp").alias(stamp_col), "route")
