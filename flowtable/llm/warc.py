"""Zstandard WARC archives: one writer and one reader.

An archive is a leading skippable frame with a Zstandard dictionary, then one
frame per WARC record. The reader loads the dictionary, walks the frames by
their block headers, decodes one record at a time and validates version line,
mandatory headers, block length and digests; a record (or a rest of a file)
that fails gives one row with ``error`` set and no payload, and never stops
the others.

Archives are written by tasks through ``pyarrow.fs`` to the shared folder's
own file system: to a name of the attempt first, then moved into place, and
only files named in the written manifest are read, so lost executors and
repeated tasks leave no doubled records. Reading uses Spark's binary source.
An archive holds about ``ARCHIVE_BYTES`` of payload, which bounds both sides'
memory (one larger record makes one larger archive).

Equal payloads (SHA-256 and length) are stored once: the row with the largest
page_id is the response, the others are revisit records that refer to it.

Defined cases: null html is an empty payload; null urls have no target URI;
a null page_id has the record id ``urn:page:null`` and is never referred to if
another id has the same payload; rows that repeat the largest page_id are all
responses; an empty table writes no archive and gives no rows; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import materialize, maybe_broadcast, work_path

ARCHIVE_BYTES = 16 << 20
LEVEL = 3
DICT_BYTES = 16 << 10
DICT_SAMPLE = 64  # first records of an archive that its dictionary is trained on
SKIPPABLE = 0x184D2A5D  # fixed values of the formats
DICT_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables have no fetch time


def _base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(page_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Block-Digest: sha1:{_base32(block)}", f"WARC-Payload-Digest: sha1:{_base32(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICT_BYTES, [r[:1 << 14] for r in records[:DICT_SAMPLE]])
    except zstandard.ZstdError:  # too few or too uniform samples
        return None


def pack(records: list[bytes]) -> bytes:
    """One archive of the given records."""
    trained = _dictionary(records)
    out = []
    if trained is not None:
        raw = trained.as_bytes()
        out.append(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True).compress
    out += map(compress, records)
    return b"".join(out)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, payload, refers_to`` rows as archives in
    ``folder``; the manifest: ``path, n_records`` of the archives in place."""
    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
            else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        held, size = [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}.tmp") as out:
                out.write(pack(held))
            store.move(f"{root}/{name}.tmp", f"{root}/{name}")
            row = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(held)], pa.int64())],
                                             names=["path", "n_records"])
            held.clear()
            return row

        for batch in batches:
            for r in range(batch.num_rows):
                pid, url, payload, ref = (batch.column(i)[r].as_py() for i in range(4))
                held.append(_record(pid, url, payload, ref))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return materialize(pages.select("page_id", "url", "payload", "refers_to").mapInArrow(
        run, "path string, n_records long"), "manifest")


def _frame_end(data: bytes, at: int) -> int:
    """Where the frame at ``at`` ends, from its block headers."""
    start = at + zstandard.frame_header_size(data[at:at + 18])
    checksum = zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
    while True:
        if start + 3 > len(data):
            raise ValueError("a frame is cut short")
        head = int.from_bytes(data[start:start + 3], "little")
        start += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    start += 4 * checksum
    if start > len(data):
        raise ValueError("a frame is cut short")
    return start


def parse(record: bytes) -> dict:
    """The headers and the payload of one decoded record; raises ValueError
    where version, headers, length or digests are not right."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name:
            raise ValueError("a header line has no name")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise ValueError("content-length is no number")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("content-length differs from the block")
    block = rest[:n]
    if headers.get("warc-block-digest", "").startswith("sha1:") and headers["warc-block-digest"][5:] != _base32(block):
        raise ValueError("the block digest differs")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        _, found, payload = block.partition(b"\r\n\r\n")
        if not found:
            raise ValueError("the HTTP head has no end")
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "revisit":
        payload = None
    elif digest.startswith("sha1:") and digest[5:] != _base32(payload):
        raise ValueError("the payload digest differs")
    return {"record_id": headers["warc-record-id"], "record_type": headers["warc-type"],
            "url": headers.get("warc-target-uri"), "refers_to": headers.get("warc-refers-to"),
            "payload_digest": digest[5:] if digest.startswith("sha1:") else None, "payload": payload}


_FIELDS = ("path", "offset", "record_id", "record_type", "url", "refers_to", "payload_digest", "payload", "error")
_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(),
          pa.string())
_SCHEMA = ("path string, offset long, record_id string, record_type string, url string, refers_to string, "
           "payload_digest string, payload binary, error string")


def unpack(data: bytes):
    """(offset, record as a dict, error) of every record of an archive."""
    at, trained = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        raw, at = data[8:8 + size], 8 + size
        try:
            if raw[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            if raw[:4] != DICT_MAGIC:
                raise ValueError("the leading frame holds no dictionary")
            trained = zstandard.ZstdCompressionDict(raw)
        except (ValueError, zstandard.ZstdError) as exc:
            yield 0, None, f"{exc}"
            return
    decoder = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(data):
        if len(data) >= at + 8 and 0x184D2A50 <= struct.unpack_from("<I", data, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        try:
            end = _frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as exc:
            yield at, None, f"{exc}"  # without its end, nothing after it can be found
            return
        try:
            yield at, parse(decoder.decompressobj().decompress(data[at:end])), None
        except (ValueError, zstandard.ZstdError) as exc:
            yield at, None, f"{exc}"
        at = end


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """One row per record of the archives in ``folder``; with the ``manifest``
    of a write, without archives that it does not name (those of attempts that
    were lost after they had written). Names are compared in tasks; only such
    strays, few if any, are sent around."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                path, rows, size = batch.column(0)[r].as_py(), [], 0
                for offset, found, error in unpack(batch.column(1)[r].as_py()):
                    found = found or {}
                    rows.append((path, offset, *(found.get(f) for f in _FIELDS[2:-1]), error))
                    size += len(found.get("payload") or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=list(_FIELDS))
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=list(_FIELDS))

    if manifest is not None and manifest.isEmpty():
        return spark.createDataFrame([], _SCHEMA)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    name = F.substring_index("path", "/", -1)
    if manifest is not None:
        known = manifest.select(F.substring_index("path", "/", -1).alias("name"))
        strays = materialize(files.select("path", name.alias("name")).join(known, "name", "left_anti").select(F.col("path").alias("stray")), "strays")
        files = files.join(maybe_broadcast(strays), F.col("path") == F.col("stray"), "left_anti")
    return files.select("path", "content").mapInArrow(run, _SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all ``pages`` (page_id, url, html) as archives, read them back:
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    error`` per record."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("same"), F.length(payload).alias("n"))
    groups = rows.groupBy("same", "n").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("c")) \
        .filter("c > 1 and first is not null").select(F.col("same").alias("same2"), F.col("n").alias("n2"), "first")
    groups = maybe_broadcast(materialize(groups, "equal-payloads"), row_bytes=160)
    marked = rows.join(groups, (rows["same"] == groups["same2"]) & (rows["n"] == groups["n2"]), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    marked = marked.select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page_id"), "url", "payload",
                           refers.cast("string").alias("refers_to"))
    folder = work_path(spark, "archives")
    records = read_archives(spark, folder, write_archives(marked, folder))

    number = r"^<urn:page:(-?[0-9]+)>$"
    read = records.select(
        F.regexp_extract("record_id", number, 1).try_cast("long").alias("page_id"),
        "url", F.length("payload").cast("long").alias("own_bytes"), "payload_digest", "record_type",
        F.regexp_extract("refers_to", number, 1).try_cast("long").alias("refers_to"),
        "error")
    read = materialize(read, "records")
    # A revisit has no payload of its own: its length is that of the response it names.
    named = read.filter("record_type = 'response' and page_id is not null") \
        .groupBy(F.col("page_id").alias("p2"), F.col("payload_digest").alias("d2")).agg(F.max("own_bytes").alias("full"))
    revisits = read.filter("record_type = 'revisit'")
    solved = revisits.join(named, (revisits["refers_to"] == named["p2"]) & (revisits["payload_digest"] == named["d2"]), "left") \
        .select("page_id", "url", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
                F.coalesce("error", F.when(F.col("full").isNull(), F.lit("the response is missing"))).alias("error"))
    plain = read.filter("record_type is null or record_type <> 'revisit'") \
        .select("page_id", "url", F.col("own_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "error")
    return plain.unionByName(solved)
