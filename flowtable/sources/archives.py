"""Zip archives as rows: one row per entry, read whole.

Reading has two steps. Tasks open the archives at random places and read only
their central directories: one row per entry with the place of its bytes.
These rows are then dealt out in slices of about ``SLICE_BYTES`` compressed
bytes, so that one large archive is read by many tasks, each by range reads of
its own entries; no task holds an archive. Everything after the unpacking is
native Spark.
"""

from __future__ import annotations

import bz2
import io
import lzma
import struct
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowtable.operators.listing import full_match, scan_inventory
from flowtable.session import cluster_cores, stored
from flowtable.sources.files import write_files
from flowtable.sources.stores import random_access

ENTRY_SCHEMA = "archive string, entry_index int, entry_name string, content string, route string"
DIRECTORY_SCHEMA = ("archive string, entry_index int, entry_name string, start long, packed long, size long, method int, "
                    "crc long, encrypted boolean, route string")
SLICE_BYTES = 32 << 20
MAX_ENTRY_BYTES = 1 << 30  # of one unpacked entry: a cell cannot be much larger
_LOCAL_HEADER = struct.Struct("<4s5H3I2H")
_PIECE = 1 << 20

_DIRECTORY = [("archive", pa.string()), ("entry_index", pa.int32()), ("entry_name", pa.string()), ("start", pa.int64()),
              ("packed", pa.int64()), ("size", pa.int64()), ("method", pa.int32()), ("crc", pa.int64()),
              ("encrypted", pa.bool_()), ("route", pa.string())]
_ENTRY = [("archive", pa.string()), ("entry_index", pa.int32()), ("entry_name", pa.string()), ("content", pa.string()),
          ("route", pa.string())]


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)],
                                      names=[name for name, _ in fields])


def _directory(archive: str) -> list[tuple]:
    """The central directory of an archive, folders left out; one row without
    an entry for an empty archive (``success``) or an unreadable one."""
    try:
        with random_access(archive) as file, zipfile.ZipFile(file) as z:
            entries = [i for i in z.infolist() if not i.is_dir()]
        rows = [(archive, n, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC,
                 bool(i.flag_bits & 1), "success") for n, i in enumerate(entries)]
        return rows or [(archive, *[None] * 8, "success")]
    except (zipfile.BadZipFile, OSError, ValueError, EOFError, struct.error, NotImplementedError, IndexError):
        return [(archive, *[None] * 8, "failure")]


def _directories(batches):
    for batch in batches:
        for archive in batch.column("path").to_pylist():
            rows = _directory(archive)
            for at in range(0, len(rows), 10_000):
                yield _batch(rows[at:at + 10_000], _DIRECTORY)


def _unpacker(method: int):
    return {zipfile.ZIP_DEFLATED: lambda: zlib.decompressobj(-15), zipfile.ZIP_BZIP2: bz2.BZ2Decompressor,
            zipfile.ZIP_LZMA: _Lzma}[method]()


class _Lzma:
    """The LZMA form that zip archives use: a header of its own in front."""

    def __init__(self):
        self.inner, self.head = None, b""

    def decompress(self, data: bytes, limit: int = -1) -> bytes:
        if self.inner is None:
            self.head += data
            if len(self.head) < 4 or len(self.head) < 4 + struct.unpack("<H", self.head[2:4])[0]:
                return b""
            n = struct.unpack("<H", self.head[2:4])[0]
            props = lzma._decode_filter_properties(lzma.FILTER_LZMA1, self.head[4:4 + n])
            self.inner = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[props])
            data, self.head = self.head[4 + n:], b""
        return self.inner.decompress(data, limit)


def _content(file, start: int, packed: int, size: int, method: int, crc: int, most: int) -> bytes:
    """One entry by range reads; never more than its declared size in memory."""
    if size > most:
        raise ValueError("entry too large")
    file.seek(start)
    head = _LOCAL_HEADER.unpack(file.read(_LOCAL_HEADER.size))
    if head[0] != b"PK\x03\x04":
        raise ValueError("no entry here")
    file.seek(start + _LOCAL_HEADER.size + head[9] + head[10])
    out, left, found = io.BytesIO(), packed, 0
    unpack = None if method == zipfile.ZIP_STORED else _unpacker(method)
    while left:
        piece = file.read(min(left, _PIECE))
        if not piece:
            raise EOFError("archive ends inside an entry")
        left -= len(piece)
        while True:
            # One byte more than declared is enough to tell that the size is wrong.
            part = piece if unpack is None else unpack.decompress(piece, size - found + 1)
            found += len(part)
            if found > size:
                raise ValueError("entry larger than declared")
            out.write(part)
            piece = getattr(unpack, "unconsumed_tail", b"")
            if not piece:
                break
    data = out.getvalue()
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("size or checksum differs")
    return data


def _entries(batches, encoding: str, most: int):
    name, file = None, None
    rows: list[tuple] = []
    weight = 0
    for batch in batches:
        for row in batch.to_pylist():
            archive, index = row["archive"], row["entry_index"]
            if index is None:
                rows.append((archive, None, None, None, row["route"]))
                continue
            try:
                if row["encrypted"]:
                    raise ValueError("encrypted entry")
                if archive != name:
                    name, file = archive, random_access(archive)
                data = _content(file, row["start"], row["packed"], row["size"], row["method"], row["crc"], most)
                rows.append((archive, index, row["entry_name"], data.decode(encoding, errors="replace"), "success"))
                weight += len(data)
            except (OSError, ValueError, EOFError, KeyError, zlib.error, lzma.LZMAError, struct.error):
                rows.append((archive, index, row["entry_name"], None, "failure"))
            if weight >= _PIECE or len(rows) >= 1000:
                yield _batch(rows, _ENTRY)
                rows, weight = [], 0
    if rows:
        yield _batch(rows, _ENTRY)


def zip_directory(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """The entries of every archive under ``path`` without their content:
    archive, entry_index (0-based), entry_name, start, packed, size, method,
    crc, encrypted, route."""
    pattern = "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() and c != "_" else c) for c in glob)
    archives = scan_inventory(spark, path).where(~F.col("is_dir") & full_match(F.col("name"), f"(?s){pattern}")).select("path")
    return archives.repartition(cluster_cores(spark) * 4).mapInArrow(_directories, DIRECTORY_SCHEMA)


def zip_entries(spark: SparkSession, path: str, glob: str = "*.zip", encoding: str = "utf-8",
                slice_bytes: int = SLICE_BYTES, max_entry_bytes: int = MAX_ENTRY_BYTES) -> DataFrame:
    """Entries of every archive under ``path``: archive, entry_index (0-based),
    entry_name, content (decoded text), route. An unreadable archive gives one
    ``failure`` row, an empty one a row without entry. An entry that is
    damaged, encrypted, of an unknown method or larger than
    ``max_entry_bytes`` gives a ``failure`` row without content; the other
    entries of its archive are read all the same."""
    directory = stored(zip_directory(spark, path, glob), "zip-directory")
    # Neighbouring entries of an archive go to one slice of about slice_bytes.
    before = Window.partitionBy("archive").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sliced = directory.withColumn("slice", F.floor(F.coalesce(F.sum("packed").over(before), F.lit(0)) / slice_bytes))
    # As many tasks as there are slices' worth of bytes, and one a core at least.
    total = directory.agg(F.sum("packed")).first()[0] or 0
    tasks = max(cluster_cores(spark), min(-(-total // slice_bytes), 100_000))
    dealt = sliced.repartition(int(tasks), "archive", "slice").sortWithinPartitions("archive", "start")
    return dealt.drop("slice").mapInArrow(lambda it: _entries(it, encoding, max_entry_bytes), ENTRY_SCHEMA)


def write_zip_archives(df: DataFrame, out_dir: str, archive_col: str, name_col: str, text_col: str,
                       order_col: str) -> None:
    """Write one zip archive ``<archive>.zip`` per ``archive_col`` value into
    ``out_dir`` (entries in ``order_col`` order). Rows are hash-partitioned by
    archive and sorted within partitions, so each task packs its archives one
    after another; the file sink commits them. Archive groups must be bounded
    in size by the caller (e.g. bucket a hot key)."""
    def pack(batches):
        key, buf, z = None, None, None

        def done():
            z.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{key}.zip"]), pa.array([buf.getvalue()], pa.binary())],
                                              names=["relpath", "content"])

        for batch in batches:
            for k, n, t in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if k != key or z is None:
                    if z is not None:
                        yield done()
                    key, buf = k, io.BytesIO()
                    z = zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                z.writestr(n, (t or "").encode("utf-8"))
        if z is not None:
            yield done()

    rows = df.select(F.col(archive_col).cast("string").alias("k"), F.col(name_col).cast("string").alias("n"),
                     F.col(text_col).alias("t"), F.col(order_col).alias("o"))
    ordered = rows.repartition("k").sortWithinPartitions("k", "o").select("k", "n", "t")
    write_files(ordered.mapInArrow(pack, "relpath string, content binary"), out_dir, "relpath", "content")


def first_value_per_archive(matches: DataFrame, archive_col: str = "archive", index_col: str = "entry_index",
                            value_col: str = "value", route_col: str = "entry_route") -> DataFrame:
    """First entry (in archive order) with a non-null value wins; archives
    without one have ``found = false``. One partial aggregate per archive."""
    first = F.min(F.when(F.col(value_col).isNotNull(), F.struct(F.col(index_col).alias("i"),
                                                                F.col(value_col).alias("v"))))
    agg = matches.groupBy(archive_col).agg(first.alias("_f"), F.max(F.when(F.col(route_col) == "failure", 1)).alias("_bad"))
    return agg.select(archive_col, F.col("_f.i").alias("entry_index"), F.col("_f.v").alias("value"),
                      F.col("_f").isNotNull().alias("found"),
                      F.when(F.col("_bad") == 1, F.lit("failure")).otherwise(F.lit("success")).alias("route"))
