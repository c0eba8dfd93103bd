"""Slant range to ground range: samples above the bottom go, the rest is gathered to its true distance.

A depth beyond the half width counts as the half width. Null bottoms give rows of zeros.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import LINE
from seaswath.functions import arrays


def with_depths(pings: DataFrame, bottom: DataFrame, offset: tuple[int, int]) -> DataFrame:
    """pings with xb_port and xb_stbd: samples of water column on each side."""
    h = arrays.half_width(F.col("bs"))
    rows = pings.join(bottom.select(LINE, "ping", "port_x", "stbd_x"), [LINE, "ping"])
    return rows.withColumn("xb_port", h - F.col("port_x") + offset[0]).withColumn("xb_stbd", F.col("stbd_x") - h + offset[1])


def ground(h: Column, xb: Column) -> Column:
    """Ground samples beyond a water column: floor(sqrt(h^2 - xb^2)), 0 where the column is longer than h."""
    h, xb = h.cast("double"), xb.cast("double")
    return F.floor(F.sqrt(F.greatest(F.lit(0.0), h * h - xb * xb))).cast("int")


def widths(rows: DataFrame) -> DataFrame:
    """line, width (of either side), min_port_width, min_stbd_width of rows with depths."""
    h = F.max(arrays.half_width(F.col("bs")))
    low = rows.groupBy(LINE).agg(h.alias("_h"), *(f(f"xb_{s}").alias(f"_{n}_{s}") for s in ("port", "stbd") for n, f in (("min", F.min), ("max", F.max))))
    width = F.greatest(ground(F.col("_h"), F.col("_min_port")), ground(F.col("_h"), F.col("_min_stbd")))
    return low.select(LINE, width.alias("width"), ground(F.col("_h"), F.col("_max_port")).alias("min_port_width"), ground(F.col("_h"), F.col("_max_stbd")).alias("min_stbd_width"))


def gathered(at: Callable[[Column], Column], half: Column, xb: Column, width: Column) -> Column:
    """Samples of a side at ground distances 0 to width - 1; 0 beyond its end. at(j): its sample j places from nadir, of half a row.

    Samples are taken from the whole row: a half cut out inside the lambda would be copied anew for each of them.
    """
    xb = xb.cast("double")
    source = lambda x: F.floor(F.sqrt(xb * xb + x.cast("double") * x.cast("double"))).cast("int")
    return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda x: F.when(source(x) < half, at(source(x))).otherwise(0.0))).otherwise(F.array().cast("array<double>"))


def correct(pings: DataFrame, bottom: DataFrame, offset: tuple[int, int] = (2, 5)) -> DataFrame:
    """pings with bs in ground range, and the line's width, min_port_width and min_stbd_width."""
    rows = with_depths(pings, bottom, offset)
    rows = rows.join(widths(rows), LINE)  # a row for each line
    h = arrays.half_width(F.col("bs"))
    port = gathered(lambda j: F.get("bs", h - 1 - j), h, F.col("xb_port"), F.col("width"))
    stbd = gathered(lambda j: F.get("bs", h + j), h, F.col("xb_stbd"), F.col("width"))
    return rows.withColumn("bs", arrays.joined_halves(port, stbd)).drop("xb_port", "xb_stbd", "port_x", "stbd_x")
