"""Mosaic of geocoded tiles: union extent, placement, greatest value of each cell.

Tiles are sparse pixels (line, row, col, value) and one row of metadata a line. Tiles of different
resolutions cannot be merged: they raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import LINE


def corners(meta: DataFrame) -> DataFrame:
    """line, min_x, max_y, max_x, min_y."""
    return meta.select(LINE, F.col("ulx").alias("min_x"), F.col("uly").alias("max_y"), (F.col("ulx") + F.col("w") * F.col("res")).alias("max_x"), (F.col("uly") - F.col("h") * F.col("res")).alias("min_y"))


def extent(meta: DataFrame) -> DataFrame:
    """One row: ulx, uly, res, h, w, epsg of the union; no row for no tile."""
    ends = corners(meta).join(meta.select(LINE, "res", "epsg"), LINE).agg(F.min("min_x").alias("ulx"), F.max("max_y").alias("uly"), F.max("max_x").alias("x1"), F.min("min_y").alias("y0"), F.when(F.min("res") < F.max("res"), F.raise_error("tiles of different resolutions")).otherwise(F.min("res")).alias("res"), F.min("epsg").alias("epsg"))
    size = lambda a, b: F.ceil((F.col(a) - F.col(b)) / F.col("res")).cast("int")
    return ends.where("res IS NOT NULL").select("ulx", "uly", "res", size("uly", "y0").alias("h"), size("x1", "ulx").alias("w"), "epsg")


def placed(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """line, row, col (of the mosaic), value: offsets are cut to whole pixels."""
    union = extent(meta).select(F.col("ulx").alias("_x"), F.col("uly").alias("_y"))
    # One row of the union meets one row a tile; then tiles' offsets meet their pixels.
    offsets = meta.join(F.broadcast(union)).select(LINE, F.floor((F.col("ulx") - F.col("_x")) / F.col("res")).cast("int").alias("_c"), F.floor((F.col("_y") - F.col("uly")) / F.col("res")).cast("int").alias("_r"))
    return pixels.join(offsets, LINE).select(LINE, (F.col("row") + F.col("_r")).alias("row"), (F.col("col") + F.col("_c")).alias("col"), "value")


def merged(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """row, col, value of the mosaic: the greatest of each cell, summed up map-side before the shuffle."""
    return placed(pixels, meta).groupBy("row", "col").agg(F.max("value").alias("value"))
