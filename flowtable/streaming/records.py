"""A topic with an exact bound on the records of a trigger.

The topic is a folder of JSON-lines files. Offsets are places in them: the
number of a file in the source's log and a byte. The driver only plans: it
counts line ends from the last place on until the trigger is full (so it reads
no more than one trigger's bytes) and hands out byte ranges; executors read the
ranges. Only when the files in the log do not fill a trigger does it list the
folder and append what is new in (time, name) order, so a trigger over a long
backlog costs the same however many files there are. The log and the last
planned place are small files beside the checkpoint, so a restarted query goes
on where it stopped, and a replayed batch reads the same bytes.

Most of a small trigger is Spark's fixed cost, so a long backlog is drained by
several queries side by side: files are dealt to lanes by a hash of their
names, and each lane is a query of its own with its own log, checkpoint, sink
and record bound.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from flowtable.session import cluster_cores
from flowtable.sources.stores import open_store
from flowtable.streaming.topic import DEFAULT_MAX_PER_TRIGGER, TS_OPTIONS, start_drain

FORMAT = "flowtable_records"
_PIECE = 1 << 16
_ROWS = 10_000
# Ranges share a task up to so many bytes together; a longer range has its own.
_TASK_BYTES = 1 << 20
# Queries that drain a topic side by side; each has a Python process at the driver.
MAX_LANES = 4


def _listing(topic: str) -> list[fs.FileInfo]:
    store, folder = open_store(topic)
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [i for i in found if i.type == fs.FileType.File and i.base_name[0] not in "_."]


@dataclass
class _Ranges(InputPartition):
    """What one task reads: (file, first byte, end) of each range."""
    parts: list[tuple[str, int, int]]


class _RecordReader(DataSourceStreamReader):
    def __init__(self, topic: str, log: str, most: int, lane: int = 0, lanes: int = 1):
        self.topic, self.log, self.most, self.lane, self.lanes = topic, log, most, lane, lanes
        self.known: list[tuple[str, int]] | None = None

    # The log: one file per discovery, each a list of (name, size).
    def _store(self) -> tuple[fs.FileSystem, str]:
        store, folder = open_store(self.log)
        store.create_dir(folder, recursive=True)
        return store, folder

    def _read_json(self, name: str):
        store, folder = self._store()
        with store.open_input_stream(f"{folder}/{name}") as f:
            return json.loads(f.read())

    def _write_json(self, name: str, value) -> None:
        store, folder = self._store()
        with store.open_output_stream(f"{folder}/.{name}.tmp") as f:
            f.write(json.dumps(value).encode())
        store.move(f"{folder}/.{name}.tmp", f"{folder}/{name}")

    def _files(self) -> list[tuple[str, int]]:
        """The files of the log; only this reader appends to it, so it is read once."""
        if self.known is None:
            store, folder = self._store()
            names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(folder)))
            parts = [n for n in names if n.startswith("files-")]
            # a log keeps its share of the files: another one would lose or repeat some
            share = self._read_json("lane") if "lane" in names else [0, 1]
            if parts and share != [self.lane, self.lanes]:
                raise ValueError(f"{self.log} belongs to lane {share[0]} of {share[1]}")
            if not parts:
                self._write_json("lane", [self.lane, self.lanes])
            self.known = [tuple(e) for part in parts for e in self._read_json(part)]
        return self.known

    def _discover(self) -> int:
        """Appends the lane's new files to the log; returns their number."""
        known = self._files()
        names = {n for n, _ in known}
        new = sorted((i.mtime_ns or 0, i.base_name, i.size) for i in _listing(self.topic)
                     if i.base_name not in names and zlib.crc32(i.base_name.encode()) % self.lanes == self.lane)
        if new:
            added = [(n, s) for _, n, s in new]
            self._write_json(f"files-{len(known):012}", added)
            known += added
        return len(new)

    def _planned(self) -> dict:
        store, folder = self._store()
        if store.get_file_info(f"{folder}/planned").type == fs.FileType.File:
            return self._read_json("planned")
        return self.initialOffset()

    def initialOffset(self) -> dict:
        return {"file": 0, "byte": 0}

    def latestOffset(self) -> dict:
        """The place at most ``most`` records after the last planned one."""
        files, at = self._files(), self._planned()
        number, byte, left = at["file"], at["byte"], self.most
        store, folder = open_store(self.topic)
        while left:
            if number == len(files):  # only before the first file is found
                if not self._discover():
                    break
            name, size = files[number]
            if byte >= size:
                if number + 1 == len(files) and not self._discover():
                    break
                number, byte = number + 1, 0
                continue
            with store.open_input_file(f"{folder}/{name}") as f:
                f.seek(byte)
                while byte < size and left:
                    piece = f.read(min(_PIECE, size - byte))
                    place = -1
                    while left and (end := piece.find(b"\n", place + 1)) >= 0:
                        place, left = end, left - 1
                    if left and byte + len(piece) == size and place < len(piece) - 1:
                        place, left = len(piece) - 1, left - 1  # a last line without its end
                    byte += place + 1 if not left else len(piece)
        return {"file": number, "byte": byte}

    def partitions(self, start: dict, end: dict) -> list[_Ranges]:
        self._write_json("planned", end)
        files, out, free = self._files(), [], 0
        for number in range(start["file"], min(end["file"], len(files) - 1) + 1):
            name, size = files[number]
            a = start["byte"] if number == start["file"] else 0
            b = end["byte"] if number == end["file"] else size
            if a < b:
                if not out or b - a > free:
                    out.append(_Ranges([]))
                    free = _TASK_BYTES
                out[-1].parts.append((name, a, b))
                free -= b - a
        return out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(self.topic)
        lines = []
        for name, start, end in partition.parts:
            with store.open_input_file(f"{folder}/{name}") as f:
                f.seek(start)
                left, rest = end - start, b""
                while left:
                    piece = f.read(min(_PIECE, left))
                    if not piece:
                        raise EOFError(f"{name} became shorter")
                    left -= len(piece)
                    *whole, rest = (rest + piece).split(b"\n")
                    lines += whole
                    if len(lines) >= _ROWS:
                        yield _batch(lines)
                        lines = []
                if rest:
                    lines.append(rest)
        if lines:
            yield _batch(lines)

    def commit(self, end: dict) -> None:
        pass


def _batch(lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())], names=["value"])


class RecordTopic(DataSource):
    """``spark.readStream.format("flowtable_records")``: one row (``value``) per line."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        o = self.options
        return _RecordReader(o["path"], o["log"], int(o["maxRecordsPerTrigger"]), int(o.get("lane", 0)), int(o.get("lanes", 1)))


def record_topic(spark: SparkSession, topic_path: str, schema: T.StructType | str, log_path: str,
                 max_records_per_trigger: int = DEFAULT_MAX_PER_TRIGGER, lane: int = 0, lanes: int = 1) -> DataFrame:
    """Streaming DataFrame of a topic's objects, at most
    ``max_records_per_trigger`` of them in any micro-batch however the files
    are cut. ``log_path`` belongs to one query, like its checkpoint. An empty
    line is a record without values. Run it with a processing-time trigger.
    With ``lanes``, it has the files of one ``lane`` (from 0) of so many; a
    restarted query names the same."""
    spark.dataSource.register(RecordTopic)
    lines = spark.readStream.format(FORMAT).option("path", topic_path).option("log", log_path) \
        .option("maxRecordsPerTrigger", int(max_records_per_trigger)).option("lane", lane).option("lanes", lanes).load()
    parsed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return lines.select(F.from_json("value", parsed, TS_OPTIONS).alias("r")).select("r.*")


def drain_records(spark: SparkSession, topic_path: str, schema: T.StructType | str, base: str,
                  max_records_per_trigger: int = DEFAULT_MAX_PER_TRIGGER, lanes: int | None = None) -> DataFrame:
    """Drain everything that the topic holds into file sinks under ``base``
    and return what they hold. By default there is a lane per core of the
    cluster, at most ``MAX_LANES`` and no more than files; no trigger of any
    lane takes more than ``max_records_per_trigger`` records."""
    if lanes is None:
        lanes = max(1, min(MAX_LANES, cluster_cores(spark), len(_listing(topic_path))))
    running = []
    try:
        for lane in range(lanes):
            stream = record_topic(spark, topic_path, schema, f"{base}/log-{lane}", max_records_per_trigger, lane, lanes)
            running.append(start_drain(stream, f"{base}/sink-{lane}", f"{base}/checkpoint-{lane}", "0 seconds"))
        for q in running:
            q.processAllAvailable()
    finally:
        for q in running:
            q.stop()
    # one read a sink: only a path read alone goes by the sink's log of finished batches
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(f"{base}/sink-{lane}") for lane in range(lanes)])
