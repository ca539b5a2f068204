"""Registered raster queries: 64-wide embeddings as 8×8 integer rasters."""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from flowtable.operators.raster import raster_bounds, raster_crop, raster_text, raster_zoom, read_images, to_raster
from flowtable.plans.registry import query
from flowtable.session import scratch_path
from flowtable.sources.files import write_files
from flowtable.sources.tables import load

WIDTH = 8


def rasters(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings")
    pixels = F.transform("embedding", lambda v: F.floor(v.cast("double") * 100).cast("int"))
    return emb.select("vec_id", "label", to_raster(pixels, WIDTH).alias("img"))


_IMG_SQL = """list_transform(range(0, 8), lambda i: list_transform(embedding[i * 8 + 1 : i * 8 + 8],
                   lambda v: CAST(floor(CAST(v AS DOUBLE) * 100) AS INTEGER)))"""


def _text_sql(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda r: array_to_string(r, ' ')), ';')"


@query("raster_crop", oracle=f"""
WITH r AS (SELECT vec_id, label, {_IMG_SQL} AS img FROM embeddings)
SELECT vec_id,
       CASE WHEN label + 4 <= 8 THEN 'success' ELSE 'failure' END AS route,
       CASE WHEN label + 4 <= 8 THEN {_text_sql('list_transform(img[2:4], lambda row: row[label + 1 : label + 4])')} END
         AS crop_text
FROM r
""")
def q_raster_crop(spark, sf_dir):
    # per-row crop origin: x = label (0-9), so labels above 4 fall outside the raster
    cropped = raster_crop(rasters(spark, sf_dir), "img", F.col("label"), 1, 4, 3)
    return cropped.select("vec_id", "route", raster_text(F.col("crop")).alias("crop_text"))


@query("raster_zoom", oracle=f"""
WITH r AS (SELECT vec_id, {_IMG_SQL} AS img FROM embeddings)
SELECT vec_id,
       {_text_sql('list_transform(range(0, 16), lambda i: list_transform(range(0, 16), lambda j: img[i // 2 + 1][j // 2 + 1]))')}
         AS zoom_text
FROM r
""")
def q_raster_zoom(spark, sf_dir):
    zoomed = raster_zoom(rasters(spark, sf_dir), "img", factor=2)
    return zoomed.select("vec_id", raster_text(F.col("zoomed")).alias("zoom_text"))


_BOUND_SQL = """list_transform(range(0, 8), lambda rr: list_transform(range(0, 8), lambda cc:
  CASE WHEN ((rr = 5 OR rr = 9) AND cc >= 6 AND cc <= 9) OR ((cc = 6 OR cc = 9) AND rr >= 5 AND rr <= 9)
       THEN 255 ELSE img[rr + 1][cc + 1] END))"""


@query("raster_bounds", oracle=f"""
WITH r AS (SELECT vec_id, {_IMG_SQL} AS img FROM embeddings)
SELECT vec_id, {_text_sql(_BOUND_SQL)} AS bounded_text FROM r
""")
def q_raster_bounds(spark, sf_dir):
    # rectangle (6,5)-(9,9): partly outside the 8×8 raster, so it is clipped
    bounded = raster_bounds(rasters(spark, sf_dir), "img", 6, 5, 3, 4)
    return bounded.select("vec_id", raster_text(F.col("bounded")).alias("bounded_text"))


def png(pixels: list, width: int) -> bytes:
    """A small RGB image file: red is the pixel, green its complement, blue 7."""
    rows = b"".join(b"\0" + b"".join(bytes((p, 255 - p, 7)) for p in pixels[i:i + width]) for i in range(0, len(pixels), width))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, len(pixels) // width, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def images(spark, sf_dir, plane):
    """The embeddings as image files (and, for every tenth, a file that is no
    image beside them), read back from the folder."""
    base = scratch_path(spark, "images")
    pixels = F.transform("embedding", lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v.cast("double") * 100).cast("int") + 128)))

    def write(batches):
        for b in batches:
            names, files = [], []
            for i, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                names.append(f"{i % 7}/{i}.png")
                files.append(png(p, WIDTH))
                if i % 10 == 0:
                    names.append(f"{i % 7}/{i}.bad")
                    files.append(b"no image")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(files, pa.binary())], names=["relpath", "content"])

    write_files(load(spark, sf_dir, "embeddings").select("vec_id", pixels.alias("p")).mapInArrow(write, "relpath string, content binary"),
                base, "relpath", "content")
    name = F.element_at(F.split("origin", "/"), -1)
    found = read_images(spark, base, plane)
    return found.select(F.regexp_extract(name, "^([0-9]+)", 1).cast("long").alias("vec_id"), name.endswith(".bad").alias("bad"),
                        "img", F.col("route").alias("image_route"))


_PNG_SQL = """
p AS (SELECT vec_id, list_transform(range(0, 8), lambda i: list_transform(embedding[i * 8 + 1 : i * 8 + 8], lambda v:
        greatest(0, least(255, CAST(floor(CAST(v AS DOUBLE) * 100) AS INTEGER) + 128)))) AS img FROM embeddings)"""
_BAD_SQL = "UNION ALL SELECT vec_id, 'failure', NULL FROM embeddings WHERE vec_id % 10 = 0"


@query("image_crop", oracle=f"""
WITH {_PNG_SQL}
SELECT vec_id, 'success' AS route, {_text_sql('list_transform(img[2:4], lambda row: row[4:8])')} AS crop_text FROM p
{_BAD_SQL}
""")
def q_image_crop(spark, sf_dir):
    cropped = raster_crop(images(spark, sf_dir, "red"), "img", 3, 1, 5, 3)
    route = F.when(F.col("image_route") == "success", F.col("route")).otherwise("failure")
    return cropped.select("vec_id", route.alias("route"), raster_text(F.col("crop")).alias("crop_text"))


@query("image_zoom", oracle=f"""
WITH {_PNG_SQL}
SELECT vec_id, 'success' AS route,
       {_text_sql('list_transform(range(0, 16), lambda i: list_transform(range(0, 16), lambda j: 255 - img[i // 2 + 1][j // 2 + 1]))')}
         AS zoom_text FROM p
{_BAD_SQL}
""")
def q_image_zoom(spark, sf_dir):
    zoomed = raster_zoom(images(spark, sf_dir, "green"), "img", factor=2)
    return zoomed.select("vec_id", F.col("image_route").alias("route"), raster_text(F.col("zoomed")).alias("zoom_text"))


@query("image_bounds", oracle=f"""
WITH {_PNG_SQL}
SELECT vec_id, 'success' AS route, {_text_sql(_BOUND_SQL)} AS bounded_text FROM p
{_BAD_SQL}
""")
def q_image_bounds(spark, sf_dir):
    bounded = raster_bounds(images(spark, sf_dir, "red"), "img", 6, 5, 3, 4)
    return bounded.select("vec_id", F.col("image_route").alias("route"), raster_text(F.col("bounded")).alias("bounded_text"))
