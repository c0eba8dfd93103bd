"""Gray levels of a line: histogram of unit bins, clip levels, and stretches by them.

Levels belong to a whole line; they are sums over bins, so that no task holds a line. Null samples and
negative ones are not counted in bins (they count in the number of samples, as do those above the last
bin). An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seaswath.functions import arrays
from seaswath.operators.ordered import LINE


def samples(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, v: one row a sample."""
    return rows.select(LINE, F.explode(column).alias("v"))


def counted(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, bin, edge (the value is whole), count, most: samples by unit bins, counted map-side; a line without samples has one row of nulls.

    Everything else follows from this one pass: sample numbers and greatest samples too, from a row for each gray level.
    """
    v, whole = F.col("v"), F.floor("v")
    return rows.select(LINE, F.explode_outer(column).alias("v")).groupBy(LINE, whole.alias("bin"), (v == whole).alias("_edge")).agg(F.count(v).alias("count"), F.max(v).alias("most"))


def tops(counts: DataFrame) -> DataFrame:
    """line, n (samples), top (greatest one) from counts by bins."""
    return counts.groupBy(LINE).agg(F.sum("count").alias("n"), F.max("most").alias("top"))


def histogram(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, bin, count, n, top: unit bins from 0 to ceil(top) - 2, of which the last one is closed at its upper end."""
    counts = counted(rows, column)
    ends = tops(counts).withColumn("_end", F.ceil("top") - 1)
    # A value at the last edge moves to the bin below it.
    placed = counts.where("bin >= 0").join(ends, LINE).where((F.col("bin") < F.col("_end")) | ((F.col("bin") == F.col("_end")) & F.col("_edge")))
    at = F.least(F.col("bin"), F.col("_end") - 1)
    return placed.where("_end > 0").groupBy(LINE, at.alias("bin")).agg(F.sum("count").alias("count"), F.first("n").alias("n"), F.first("top").alias("top"))


def clip_levels(rows: DataFrame, ratio: float, column: str = "bs") -> DataFrame:
    """line, n, top, lo, hi: the first bins whose cumulative counts exceed ratio and 1 - ratio of all samples, else 0."""
    bins = histogram(rows, column)
    so_far = F.sum("count").over(Window.partitionBy(LINE).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = bins.withColumn("_sum", so_far)  # a row for each gray level of a line
    level = lambda share: F.min(F.when(F.col("_sum") > F.floor(F.col("n") * share), F.col("bin")))
    found = scanned.groupBy(LINE).agg(level(ratio).alias("lo"), level(1 - ratio).alias("hi"))
    return tops(counted(rows, column)).join(found, LINE, "left").select(LINE, "n", "top", F.coalesce("lo", F.lit(0)).cast("double").alias("lo"), F.coalesce("hi", F.lit(0)).cast("double").alias("hi"))


def linear_stretch(rows: DataFrame, ratio: float = 0.02, new_min: float = 1.0, new_max: float = 255.0, column: str = "bs", out: str = "gray") -> DataFrame:
    """rows with `out`: whole gray levels 1 to 255."""
    levels = clip_levels(rows, ratio, column).select(LINE, "lo", "hi")
    return rows.join(levels, LINE).withColumn(out, F.transform(column, lambda v: arrays.linear(v, F.col("lo"), F.col("hi"), new_min, new_max))).drop("lo", "hi")


def piecewise_stretch(rows: DataFrame, ratio: float = 0.02, new_min: float = 1.0, new_max: float = 255.0, column: str = "bs", out: str = "gray") -> DataFrame:
    levels = clip_levels(rows, ratio, column).select(LINE, "hi", "top")
    return rows.join(levels, LINE).withColumn(out, F.transform(column, lambda v: arrays.piecewise(v, F.col("hi"), F.col("top"), new_min, new_max))).drop("hi", "top")


def _held_top(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    top = F.greatest(F.lit(low), F.least(F.lit(high), F.max(F.array_max(column))))
    return rows.join(rows.groupBy(LINE).agg(top.alias("_top")), LINE)


def log_transform(rows: DataFrame, gain: float = 200.0, c: float = 256.0, column: str = "bs", out: str = "gray") -> DataFrame:
    held = lambda v: F.greatest(F.lit(1.0), F.least(F.lit(c), v))
    return _held_top(rows, column, 1.0, c).withColumn(out, F.transform(column, lambda v: arrays.log_stretch(held(v), F.col("_top"), gain, c))).drop("_top")


def gamma_transform(rows: DataFrame, c: float = 256.0, r: float = 0.5, column: str = "bs", out: str = "gray") -> DataFrame:
    held = lambda v: F.greatest(F.lit(1.0), F.least(F.lit(c), v))
    return _held_top(rows, column, 1.0, c).withColumn(out, F.transform(column, lambda v: arrays.gamma_stretch(held(v), F.col("_top"), c, r))).drop("_top")


def log_gain(rows: DataFrame, gain: float = 200.0, column: str = "bs", out: str = "gray") -> DataFrame:
    """Ten times the samples, held to the clip levels at one percent, stretched by logarithm up to the upper level."""
    tenfold = rows.withColumn("_ten", F.transform(column, lambda v: v * 10.0))
    levels = clip_levels(tenfold, 0.01, "_ten").select(LINE, "lo", "hi", F.greatest("lo", F.least("hi", F.col("top"))).alias("_top"))
    held = lambda v: F.greatest(F.col("lo"), F.least(F.col("hi"), v))
    joined = tenfold.join(levels, LINE)
    flat = F.coalesce(F.nullif(F.col("_top"), F.lit(0.0)), F.lit(1.0))
    return joined.withColumn(out, F.transform("_ten", lambda v: arrays.log_stretch(held(v), flat, gain, F.col("hi")))).drop("_ten", "lo", "hi", "_top")


def byte_image(rows: DataFrame, column: str = "bs", out: str = "gray") -> DataFrame:
    """Samples held to 0..255, rounded half to even."""
    return rows.withColumn(out, arrays.byte_clip(F.col(column)))


