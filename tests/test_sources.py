"""Folder listing, the committing file sink and archives read by entries."""

import grp
import io
import os
import pwd
import random
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from flowtable.operators.listing import file_inventory, scan_inventory
from flowtable.sources import files
from flowtable.sources.archives import write_zip_archives, zip_directory, zip_entries
from flowtable.sources.files import write_files


def tree(names):
    base = tempfile.mkdtemp(prefix="tree-")
    for name, text in names.items():
        os.makedirs(os.path.dirname(f"{base}/{name}"), exist_ok=True)
        with open(f"{base}/{name}", "w") as f:
            f.write(text)
    return base


def test_scan_knows_hidden_names_owners_and_modes(spark):
    base = tree({"_a.txt": "12", ".b.txt": "", "_d/x.txt": "1", "d/e/f/g.txt": "123", "d/é ü.txt": "4"})
    os.chmod(f"{base}/_a.txt", 0o640)
    os.utime(f"{base}/_a.txt", ns=(0, 1_700_000_000_123_000_000))
    os.symlink(base, f"{base}/d/loop")
    rows = {r.path[len(base) + 1:]: r for r in scan_inventory(spark, base).collect()}
    assert set(rows) == {"_a.txt", ".b.txt", "_d", "_d/x.txt", "d", "d/e", "d/e/f", "d/e/f/g.txt", "d/é ü.txt", "d/loop"}
    a = rows["_a.txt"]
    me = os.stat(base)
    assert (a.length, a.mtime_ms, a.mode, a.is_dir, a.name, a.parent) == (2, 1_700_000_000_123, 0o640, False, "_a.txt", base)
    assert (a.owner, a.group, a.replication) == (pwd.getpwuid(me.st_uid).pw_name, grp.getgrgid(me.st_gid).gr_name, None)
    assert rows["d"].is_dir and rows["d"].length is None and not rows["d/loop"].is_dir
    assert [r.permissions for r in file_inventory(scan_inventory(spark, f"file:{base}"), base).collect() if r.filename == "_a.txt"] == ["rw-r-----"]
    assert {r.name for r in scan_inventory(spark, base, recurse=False).collect()} == {"_a.txt", ".b.txt", "_d", "d"}
    with pytest.raises(FileNotFoundError):
        scan_inventory(spark, f"{base}/none")
    assert scan_inventory(spark, tempfile.mkdtemp()).count() == 0


def test_scan_does_not_read_folders_that_the_filter_leaves_out(spark):
    base = tree({"keep/a": "", "keep/skip.d/b": "", "skip.d/c/d": ""})
    names = {r.path[len(base) + 1:] for r in scan_inventory(spark, base, name_regex="[a-z]+").collect()}
    assert names == {"keep", "keep/a", "keep/skip.d", "skip.d"}


def listing(base):
    return {os.path.relpath(os.path.join(d, f), base): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(base) for f in fs}


def test_sink_writes_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="sink-")
    rows = [("a/x.txt", "é"), ("b.txt", None), ("a/y/z.txt", "line\n")]
    write_files(spark.createDataFrame(rows, "p string, t string").repartition(3), base, "p", "t")
    assert listing(base) == {"a/x.txt": "é".encode(), "b.txt": b"", "a/y/z.txt": b"line\n"}
    write_files(spark.createDataFrame([("b.txt", bytearray(b"2"))], "p string, t binary"), f"file:{base}", "p", "t")
    assert listing(base)["b.txt"] == b"2" and len(listing(base)) == 3
    for bad in ("../x", "/x", "a/"):
        with pytest.raises(Exception):
            write_files(spark.createDataFrame([(bad, "x")], "p string, t string"), base, "p", "t")
    assert len(listing(base)) == 3  # and nothing temporary is left


def test_failed_attempt_leaves_no_file(spark):
    """An attempt that fails after writing, one that is repeated, and an abort."""
    import pyarrow as pa

    class Context:
        def __init__(self, attempt):
            self.attempt = attempt

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return self.attempt

    base = tempfile.mkdtemp(prefix="sink-")
    writer = files._FileWriter(base).prepare()
    batch = pa.RecordBatch.from_arrays([pa.array(["d/a", "b"]), pa.array([b"1", b"2"], pa.binary())], names=["relpath", "content"])

    def failing():
        yield batch
        raise RuntimeError("lost")

    contexts = iter([Context(1), Context(2), Context(3)])
    get, files.TaskContext = files.TaskContext, type("T", (), {"get": staticmethod(lambda: next(contexts))})
    try:
        with pytest.raises(RuntimeError):
            writer.write(failing())
        assert not [f for f in listing(base) if not f.startswith("_temporary/")]
        first, second = writer.write([batch]), writer.write([batch])  # a speculative copy of the same task
        assert {f: v for f, v in listing(base).items() if not f.startswith("_temporary/")} == {"d/a": b"1", "b": b"2"}
        writer.commit([first, second])
        assert listing(base) == {"d/a": b"1", "b": b"2"}
        other = files._FileWriter(base).prepare()
        contexts = iter([Context(4)])
        done = other.write([pa.RecordBatch.from_arrays([pa.array(["new"]), pa.array([b"3"], pa.binary())], names=["relpath", "content"])])
        other.abort([done, None])
        assert listing(base) == {"d/a": b"1", "b": b"2"}
    finally:
        files.TaskContext = get


def archive(entries, method=zipfile.ZIP_DEFLATED):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", method) as z:
        for name, text in entries:
            z.writestr(name, text)
    return buf.getvalue()


def test_large_archive_is_read_by_many_tasks(spark):
    base, rng = tempfile.mkdtemp(prefix="zip-"), random.Random(1)
    rows = [("big", f"{i:03}.txt", "".join(rng.choices("abcdefghijklmnop", k=2000)) if i else None) for i in range(200)]
    write_zip_archives(spark.createDataFrame(rows, "a string, n string, t string"), base, "a", "n", "t", "n")
    assert os.listdir(base) == ["big.zip"]
    out = zip_entries(spark, base, slice_bytes=20_000)
    got = out.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.entry_index, r.entry_name, r.content, r.route) for r in got) == [
        (i, n, t or "", "success") for i, (_, n, t) in enumerate(rows)]
    assert len({r.task for r in got}) >= 4
    one = zip_directory(spark, base).agg(F.sum("packed"), F.count("*")).first()
    assert one[1] == 200 and one[0] < os.path.getsize(f"{base}/big.zip")


def test_bad_archives_do_not_stop_the_others(spark):
    base = tempfile.mkdtemp(prefix="zip-")
    good = archive([("a.txt", "one"), ("dir/", ""), ("b.txt", "two " * 500)])
    corrupt, locked, bomb = bytearray(good), bytearray(good), bytearray(good)
    at = good.find(b"b.txt") + 5
    corrupt[at:at + 8] = b"\xff" * 8
    locked[good.find(b"PK\x01\x02") + 8] |= 1
    place = good.rfind(b"PK\x01\x02") + 24  # declared size of the last entry
    bomb[place:place + 4] = (100).to_bytes(4, "little")
    for name, raw in {"good": good, "bad": bytes(corrupt), "locked": bytes(locked), "bomb": bytes(bomb), "junk": b"x", "cut": good[:60],
                      "none": archive([]), "bz": archive([("x", "é" * 999)], zipfile.ZIP_BZIP2), "plain": archive([("x", "s")], zipfile.ZIP_STORED),
                      "lz": archive([("x", "y" * 70_000)], zipfile.ZIP_LZMA)}.items():
        with open(f"{base}/_{name}.zip", "wb") as f:
            f.write(raw)
    with open(f"{base}/other.txt", "w") as f:
        f.write("no archive")
    got = {}
    for r in zip_entries(spark, base).collect():
        got.setdefault(os.path.basename(r.archive)[1:-4], []).append((r.entry_index, r.entry_name, len(r.content or ""), r.route))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        "good": [(0, "a.txt", 3, "success"), (1, "b.txt", 2000, "success")],
        "bad": [(0, "a.txt", 3, "success"), (1, "b.txt", 0, "failure")],
        "locked": [(0, "a.txt", 0, "failure"), (1, "b.txt", 2000, "success")],
        "bomb": [(0, "a.txt", 3, "success"), (1, "b.txt", 0, "failure")],
        "junk": [(None, None, 0, "failure")], "cut": [(None, None, 0, "failure")], "none": [(None, None, 0, "success")],
        "bz": [(0, "x", 999, "success")], "plain": [(0, "x", 1, "success")], "lz": [(0, "x", 70_000, "success")]}
    assert zip_entries(spark, base, max_entry_bytes=1000).where("content is not null and length(content) > 1000").count() == 0
