"""Raster columns (``array<array<int>>``, rows of pixels): reshape, crop,
nearest-neighbour zoom and rectangle outlines, all as array lambdas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(v) -> Column:
    if isinstance(v, str):
        return F.col(v)
    return v if isinstance(v, Column) else F.lit(v)


def to_raster(flat: Column, width: int) -> Column:
    """Flat pixel array → rows of ``width`` pixels (the last may be shorter; no
    pixels give no rows)."""
    rows = F.ceil(F.size(flat) / F.lit(width)).cast("int")
    return F.when(rows <= 0, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), rows - 1),
                       lambda i: F.slice(flat, i * width + 1, F.lit(width))))


def raster_text(img: Column) -> Column:
    """Rows joined by ``;``, pixels by spaces (a stable text form for checks)."""
    return F.array_join(F.transform(img, lambda r: F.array_join(r, " ")), ";")


# The planes of an image of 1, 3 or 4 channels in the order of its bytes.
PLANES = {1: ("gray",), 3: ("blue", "green", "red"), 4: ("blue", "green", "red", "alpha")}


def image_plane(image: Column, plane: str) -> Column:
    """One plane (``gray``, ``blue``, ``green``, ``red`` or ``alpha``) of a struct
    of Spark's ``image`` source as a raster; null where the image has no such
    plane. Bytes are read by array expressions. A gray image has its one plane
    under every colour's name."""
    n, width, height = image["nChannels"], image["width"], image["height"]
    at = F.lit(None).cast("int")
    for channels, names in PLANES.items():
        if plane in names:
            at = F.when(n == channels, F.lit(names.index(plane))).otherwise(at)
    if plane in ("blue", "green", "red"):
        at = F.when(n == 1, F.lit(0)).otherwise(at)
    # Two hexadecimal digits a byte, read by their place in the digits' row.
    digits = F.hex(image["data"])

    def value(byte: Column) -> Column:
        digit = lambda i: F.instr(F.lit("123456789ABCDEF"), F.substring(digits, (byte * 2 + i).cast("int"), F.lit(1)))
        return digit(1) * 16 + digit(2)

    rows = F.transform(F.sequence(F.lit(0), height - 1), lambda r: F.transform(
        F.sequence(F.lit(0), width - 1), lambda c: value((r * width + c) * n + at)))
    return F.when(at.isNotNull() & (height > 0) & (width > 0), rows)


def read_images(spark: SparkSession, path: str, plane: str = "gray", out_col: str = "img") -> DataFrame:
    """Image files below ``path`` as rasters: ``origin``, ``height``, ``width``,
    ``channels``, ``out_col`` and ``route``. Decoding is the ``image`` source's;
    a file that is no image, or has no such plane, routes ``failure``."""
    found = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path)
    image = F.col("image")
    img = F.when(image["nChannels"] > 0, image_plane(image, plane))
    out = found.select(image["origin"].alias("origin"), image["height"].alias("height"), image["width"].alias("width"),
                       image["nChannels"].alias("channels"), img.alias(out_col))
    return out.withColumn("route", F.when(F.col(out_col).isNotNull(), F.lit("success")).otherwise(F.lit("failure")))


def raster_height(img: Column) -> Column:
    return F.size(img)


def raster_width(img: Column) -> Column:
    """Pixels of the first row; null for an empty raster."""
    return F.size(F.get(img, F.lit(0)))


def raster_crop(df: DataFrame, col: str, x, y, w, h, out_col: str = "crop") -> DataFrame:
    """Rectangle at (x, y) of w×h pixels (arguments are numbers or per-row
    columns). Out of range (or non-positive size) routes ``failure`` with a
    null crop; the input raster is kept as the original."""
    img = F.col(col)
    x, y, w, h = _c(x), _c(y), _c(w), _c(h)
    ok = ((x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x + w <= raster_width(img)) & (y + h <= raster_height(img)))
    crop = F.transform(F.slice(img, y + 1, h), lambda r: F.slice(r, x + 1, w))
    return (df.withColumn(out_col, F.when(ok, crop))
            .withColumn("route", F.when(ok, F.lit("success")).otherwise(F.lit("failure"))))


def raster_zoom(df: DataFrame, col: str, factor: int = 2, out_col: str = "zoomed") -> DataFrame:
    """Nearest-neighbour enlargement by an integer ``factor`` (default 2)."""
    if factor < 1:
        raise ValueError("factor must be >= 1")
    def repeat(a: Column) -> Column:
        return F.flatten(F.transform(a, lambda v: F.array_repeat(v, int(factor))))

    return df.withColumn(out_col, repeat(F.transform(F.col(col), repeat)))


def raster_bounds(df: DataFrame, col: str, x, y, w, h, value: int = 255, out_col: str = "bounded") -> DataFrame:
    """Copy of the raster with a one-pixel rectangle outline from (x, y) to
    (x + w, y + h) inclusive set to ``value``; parts outside are clipped."""
    img = F.col(col)
    x, y, w, h = _c(x), _c(y), _c(w), _c(h)
    x2, y2 = x + w, y + h

    def pixel(p, r, c):
        on_row = ((r == y) | (r == y2)) & (c >= x) & (c <= x2)
        on_col = ((c == x) | (c == x2)) & (r >= y) & (r <= y2)
        return F.when(on_row | on_col, F.lit(int(value))).otherwise(p)

    out = F.transform(img, lambda row, r: F.transform(row, lambda p, c: pixel(p, r, c)))
    return df.withColumn(out_col, out)
