"""A user's poll function as a streaming source, with an exact bound on the
records taken per trigger.

``poll(offset, max_records) -> (records, next_offset)`` is any importable
function (given as ``"module:function"``) that fetches at most ``max_records``
JSON-like records after ``offset`` from an external queue or API. The reader
runs on the driver side, which is why every trigger is bounded: at most
``maxRecordsPerTrigger`` records (default 10) pass per micro-batch. For bulk
data use the file topic (``topic.topic_drain``), which reads on executors.
"""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

# Fixed value: records drained per trigger in the reference.
DEFAULT_MAX_RECORDS = 10


def _resolve(spec: str):
    module, _, fn = spec.partition(":")
    return getattr(importlib.import_module(module), fn)


class _PollReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict, schema):
        self.poll = _resolve(options["poll"])
        self.max_records = int(options.get("maxRecordsPerTrigger", DEFAULT_MAX_RECORDS))
        self.columns = [f.name for f in schema.fields]

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def _rows(self, records):
        # a list iterator: Spark caches and copies it (generators cannot be copied)
        return iter([tuple(rec.get(c) for c in self.columns) if isinstance(rec, dict) else tuple(rec)
                     for rec in records])

    def read(self, start: dict):
        records, nxt = self.poll(int(start["offset"]), self.max_records)
        records = list(records)
        if len(records) > self.max_records:
            # its offset lies behind records that this trigger may not take
            raise ValueError(f"poll returned {len(records)} records, more than the {self.max_records} asked for")
        return self._rows(records), {"offset": int(nxt), "taken": len(records)}

    def readBetweenOffsets(self, start: dict, end: dict):
        # replay of a planned batch after a failure: as many records again,
        # whatever the offsets count
        want = int(end.get("taken", int(end["offset"]) - int(start["offset"])))
        records = list(self.poll(int(start["offset"]), want)[0]) if want else []
        if len(records) != want:
            raise ValueError(f"a replay got {len(records)} records instead of {want}")
        return self._rows(records)

    def commit(self, end: dict) -> None:
        pass


class PollSource(DataSource):
    """``spark.readStream.format("flowtable_poll").schema(...).option("poll", "mod:fn")``."""

    @classmethod
    def name(cls) -> str:
        return "flowtable_poll"

    def schema(self):
        return self.options["schema"]

    def simpleStreamReader(self, schema):
        return _PollReader(self.options, schema)


def poll_stream(spark: SparkSession, poll: str, schema: str,
                max_records_per_trigger: int = DEFAULT_MAX_RECORDS) -> DataFrame:
    """Streaming DataFrame over a user's poll function (see module doc)."""
    spark.dataSource.register(PollSource)
    return (spark.readStream.format("flowtable_poll").schema(schema).option("schema", schema)
            .option("poll", poll).option("maxRecordsPerTrigger", int(max_records_per_trigger)).load())
