"""Streaming operators with availableNow triggers on small folders."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from flowtable.operators.listing import FILES_SCHEMA
from flowtable.session import scratch_path
from flowtable.streaming.delay import delay_stream
from flowtable.streaming.listing import announce, emitted_so_far, listing_stream
from flowtable.streaming.topic import drain_available, publish, start_drain, topic_drain

SCHEMA = "k string, ts timestamp_ntz"


def at(sec):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)


def test_delay_stream_event_time(spark):
    base = scratch_path(spark, "t-delay")
    schema = SCHEMA + ", body string"
    # D is older than the watermark when it arrives; F carries no body
    for rows in ([("A", at(0), "a"), ("A", at(1), "a2"), ("B", at(10), "b")], [("C", at(100), "c")], [("D", at(3), "d")],
                 [("E", at(96), "e"), ("F", at(94), None)]):
        publish(spark.createDataFrame(rows, schema).coalesce(1), f"{base}/topic")
        time.sleep(0.01)
    stream = topic_drain(spark, f"{base}/topic", schema, max_files_per_trigger=1)
    out = drain_available(delay_stream(stream, delay_ms=5000, event_time_col="ts"), f"{base}/sink", f"{base}/ckpt")
    got = sorted((r.body or "", r.k, r.ts, r.delay_timestamp, r.route) for r in out.collect())
    stamp = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    every = [("a", "A", at(0)), ("a2", "A", at(1)), ("b", "B", at(10)), ("c", "C", at(100)), ("d", "D", at(3)),
             ("e", "E", at(96)), ("", "F", at(94))]
    want = [(body, k, t, stamp(t), "delay") for body, k, t in every]
    want += [(body, k, t, stamp(t), "ready") for body, k, t in every if t < at(95)]
    assert got == sorted(want)


def test_topic_drain_bounded_batches(spark):
    base = scratch_path(spark, "t-topic")
    for i in range(3):
        publish(spark.createDataFrame([(f"k{i}", at(i))], SCHEMA).coalesce(1), f"{base}/topic")
    stream = topic_drain(spark, f"{base}/topic", SCHEMA, max_files_per_trigger=1)
    out = drain_available(stream, f"{base}/sink", f"{base}/ckpt")
    assert sorted(r.k for r in out.collect()) == ["k0", "k1", "k2"]
    assert sorted(r.ts for r in out.collect()) == [at(0), at(1), at(2)]


def test_listing_stream_emits_each_file_once(spark):
    base = scratch_path(spark, "t-listing")

    def frow(name, t):
        return (f"/d/{name}", name, "/d", 1, t, "u", "g", 1, 0o644, False)

    snaps = [(100, [frow("a", 10), frow("b", 20)]),
             (200, [frow("a", 10), frow("b", 20), frow("c", 20), frow("d", 30)]),
             (300, [frow("a", 10), frow("b", 20), frow("c", 20), frow("d", 30)])]
    for as_of, rows in snaps:
        path = f"{base}/snap/{as_of}"
        spark.createDataFrame(rows, FILES_SCHEMA).write.parquet(path)
        announce(spark, f"{base}/manifests", path, as_of)
    q = listing_stream(spark, f"{base}/manifests", f"{base}/state", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    got = sorted((r.as_of_ms, r.name) for r in emitted_so_far(spark, f"{base}/out").collect())
    assert got == [(100, "a"), (200, "b"), (200, "c"), (300, "d")]


def test_delay_stream_processing_time(spark):
    base = scratch_path(spark, "t-delay-pt")
    publish(spark.createDataFrame([("A", at(0))], SCHEMA).coalesce(1), f"{base}/topic")
    publish(spark.createDataFrame([("B", at(1))], SCHEMA).coalesce(1), f"{base}/topic")
    stream = topic_drain(spark, f"{base}/topic", SCHEMA, max_files_per_trigger=1)
    q = start_drain(delay_stream(stream, delay_ms=1), f"{base}/sink", f"{base}/ckpt", "50 milliseconds")
    try:
        # processing-time timeouts keep triggers coming; let a few run, then stop
        deadline = time.time() + 60
        while time.time() < deadline:
            q.awaitTermination(2)
            done = [p for p in q.recentProgress if p["numInputRows"] == 0 and p["batchId"] >= 3]
            if done:
                break
    finally:
        q.stop()
    routes = {(r.k, r.route) for r in spark.read.parquet(f"{base}/sink").collect()}
    assert {("A", "delay"), ("A", "ready"), ("B", "delay"), ("B", "ready")} <= routes


def test_listing_stream_with_trigger_interval(spark):
    base = scratch_path(spark, "t-listing-pt")
    rows = [(f"/d/{n}", n, "/d", 1, t, "u", "g", 1, 0o644, False) for n, t in [("a", 10), ("b", 20)]]
    spark.createDataFrame(rows, FILES_SCHEMA).write.parquet(f"{base}/snap")
    announce(spark, f"{base}/manifests", f"{base}/snap", 100)
    q = listing_stream(spark, f"{base}/manifests", f"{base}/state", f"{base}/out", f"{base}/ckpt",
                       trigger_interval="100 milliseconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [r.name for r in emitted_so_far(spark, f"{base}/out").collect()] == ["a"]


def test_poll_stream_bounds_records_per_trigger(spark):
    from flowtable.streaming.poll import poll_stream

    base = scratch_path(spark, "t-poll")
    stream = poll_stream(spark, "tests.poll_fixture:poll", "id long, body string", max_records_per_trigger=10)
    q = start_drain(stream, f"{base}/sink", f"{base}/ckpt", "100 milliseconds")
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            q.awaitTermination(1)
            if sum(p["numInputRows"] for p in q.recentProgress) >= 25:
                break
        sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    finally:
        q.stop()
    assert sizes == [10, 10, 5]
    assert sorted(r.id for r in spark.read.parquet(f"{base}/sink").collect()) == list(range(25))


def test_delay_stream_with_many_waiting_records(spark):
    """A million records wait; the next triggers read only what is due."""
    from pyspark.sql import functions as F

    base = scratch_path(spark, "t-delay-many")
    schema = "id long, ts timestamp_ntz"
    day = "timestamp_ntz '2024-01-01 00:00:00'"
    early = spark.range(0, 1_000_000, numPartitions=8).selectExpr("id", f"{day} + make_dt_interval(0, 0, 0, id % 4000) as ts")
    early.write.json(f"{base}/topic")
    stream = lambda: topic_drain(spark, f"{base}/topic", schema, max_files_per_trigger=100)
    run = lambda: drain_available(delay_stream(stream(), delay_ms=4_000_000, event_time_col="ts", shards=8),
                                  f"{base}/sink", f"{base}/ckpt")
    assert run().groupBy("route").count().collect()[0][1] == 1_000_000
    publish(spark.sql(f"select 1000000L as id, {day} + make_dt_interval(0, 0, 0, 6000) as ts").coalesce(1), f"{base}/topic")
    ready = run().where("route = 'ready'")
    # due: stamps more than 4,000 s before the watermark of 6,000 s
    assert ready.count() == 500_000 and ready.agg(F.max(F.col("id") % 4000)).first()[0] == 1999
    assert ready.select("id").distinct().count() == 500_000


def test_listing_stream_starts_again_for_another_source(spark):
    base = scratch_path(spark, "t-listing-source")
    rows = [(f"/d/{n}", n, "/d", 1, t, "u", "g", 1, 0o644, False) for n, t in [("a", 10), ("b", 20)]]
    spark.createDataFrame(rows, FILES_SCHEMA).write.parquet(f"{base}/snap")
    for at_ms, source in ((100, "/d *"), (200, "/d *"), (300, "/d *.csv"), (400, "/d *.csv")):
        announce(spark, f"{base}/manifests", f"{base}/snap", at_ms, source)
        listing_stream(spark, f"{base}/manifests", f"{base}/state", f"{base}/out", f"{base}/ckpt").awaitTermination()
    got = sorted((r.as_of_ms, r.name) for r in emitted_so_far(spark, f"{base}/out").collect())
    assert got == [(100, "a"), (200, "b"), (300, "a"), (400, "b")]


def test_record_topic_bounds_every_batch_and_survives_a_restart(spark):
    from flowtable.streaming.records import _RecordReader, record_topic

    base = scratch_path(spark, "t-records")
    rows = lambda a, b: spark.range(a, b).selectExpr("id", "concat('é', id) as body").coalesce(1)
    publish(rows(0, 23), f"{base}/topic", records_per_file=7)
    publish(rows(23, 64), f"{base}/topic")
    sizes = []

    def drain(more=None):
        stream = record_topic(spark, f"{base}/topic", "id long, body string", f"{base}/log", max_records_per_trigger=10)
        q = start_drain(stream, f"{base}/sink", f"{base}/ckpt", "0 seconds")
        try:
            q.processAllAvailable()
            if more is not None:
                publish(more, f"{base}/topic")
                q.processAllAvailable()
        finally:
            q.stop()
        sizes.extend(p["numInputRows"] for p in q.recentProgress if p["numInputRows"])

    drain()
    assert sizes == [10] * 6 + [4]
    drain(rows(64, 80))  # a restart, then more arrives
    got = spark.read.parquet(f"{base}/sink").collect()
    assert sorted((r.id, r.body) for r in got) == [(i, f"é{i}") for i in range(80)]
    assert max(sizes) == 10 and sum(sizes) == 80

    # A lost batch is planned again from its logged places and reads the same bytes.
    reader = _RecordReader(f"{base}/topic", f"{base}/log2", 10)
    start, end = reader.initialOffset(), reader.latestOffset()
    read = lambda: [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert len(read()) == 10 and read() == read()
    again = _RecordReader(f"{base}/topic", f"{base}/log2", 10)
    later = again.latestOffset()
    assert [v for p in again.partitions(end, later) for b in again.read(p) for v in b.column(0).to_pylist()] != read()


def test_record_topic_lines_without_an_end(spark, tmp_path):
    from flowtable.streaming.records import _RecordReader

    topic = tmp_path / "topic"
    topic.mkdir()
    for name, text in (("a", "1\n2"), ("b", ""), ("c", "3\n" + "x" * 200_000 + "\n"), ("d", "5"), ("_skip", "no\n")):
        (topic / name).write_text(text)
    for most in (1, 2, 3, 100):
        reader = _RecordReader(str(topic), str(tmp_path / f"log{most}"), most)
        at, sizes, lines = reader.initialOffset(), [], []
        while (end := reader.latestOffset()) != at:
            got = [v for p in reader.partitions(at, end) for b in reader.read(p) for v in b.column(0).to_pylist()]
            at = end
            if got:
                sizes.append(len(got))
                lines += got
        assert sorted(map(len, lines)) == [1, 1, 1, 1, 200_000] and max(sizes) <= most and len(sizes) == -(-5 // most)


def test_record_topic_backlog_is_listed_once_and_small_ranges_share_a_task(tmp_path, monkeypatch):
    from flowtable.streaming import records

    topic, log = tmp_path / "topic", tmp_path / "log"
    topic.mkdir()
    for i in range(6):
        (topic / f"a{i}").write_text(f"{i}\n{i}\n")
    reader = records._RecordReader(str(topic), str(log), 5)
    asked = []
    real = records.fs.FileSelector
    monkeypatch.setattr(records.fs, "FileSelector", lambda path, **kw: (asked.append(path), real(path, **kw))[1])
    at, lines, tasks = reader.initialOffset(), [], []
    for step in range(4):
        if (end := reader.latestOffset()) == at:
            break
        parts = reader.partitions(at, end)
        lines += [v for p in parts for b in reader.read(p) for v in b.column(0).to_pylist()]
        tasks.append(len(parts))
        at = end
        if step == 0:  # found when the backlog is drained, in the trigger that has room for it
            (topic / "b").write_text("6\n")
    assert lines == [c for i in range(6) for c in (str(i), str(i))] + ["6"]
    assert tasks == [1, 1, 1]
    # at the start, twice in the trigger that reaches the end (the first finds b), and with nothing left to read
    assert [str(topic)] * 4 == [p for p in asked if p == str(topic)]

    monkeypatch.setattr(records, "_TASK_BYTES", 5)
    wide = records._RecordReader(str(topic), str(tmp_path / "log2"), 100)
    start, end = wide.initialOffset(), wide.latestOffset()
    parts = wide.partitions(start, end)
    assert [len(p.parts) for p in parts] == [1] * 7
    assert [v for p in parts for b in wide.read(p) for v in b.column(0).to_pylist()] == lines


def test_drain_records_lanes_take_each_file_once(spark):
    from flowtable.streaming.records import _RecordReader, drain_records

    base = scratch_path(spark, "t-lanes")
    rows = spark.range(0, 60).selectExpr("id", "concat('é', id) as body").coalesce(1)
    publish(rows, f"{base}/topic", records_per_file=7)
    for lanes in (3, 16):  # 9 files: of 16 lanes some have none
        run = scratch_path(spark, "t-lanes-run")
        got = drain_records(spark, f"{base}/topic", "id long, body string", run, max_records_per_trigger=5, lanes=lanes)
        assert sorted((r.id, r.body) for r in got.collect()) == [(i, f"é{i}") for i in range(60)]
        sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) == 5  # a trigger's small ranges are one task, so one file of a sink is one trigger

    reader = _RecordReader(f"{base}/topic", f"{base}/log", 5, 1, 3)
    end = reader.latestOffset()
    again = _RecordReader(f"{base}/topic", f"{base}/log", 5, 1, 3)
    assert again.partitions(again.initialOffset(), end) == reader.partitions(reader.initialOffset(), end)
    with pytest.raises(ValueError, match="lane 1 of 3"):
        _RecordReader(f"{base}/topic", f"{base}/log", 5, 1, 4).latestOffset()
