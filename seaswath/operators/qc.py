"""Quality control: depths, statistics, areas, histograms against the normal curve, and the summary row.

All figures are aggregates by line. Rounding is half to even, as in numeric Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import LINE

BINS = 256


def depths(bottom: DataFrame, width: int | Column, slant_range: float) -> DataFrame:
    """bottom with port_depth and stbd_depth (negative metres) and swath (metres of ground on both sides)."""
    half = (F.lit(width) if isinstance(width, int) else width) / 2.0
    res, r = F.lit(float(slant_range)) / half, F.lit(float(slant_range))
    port, stbd = -(half - F.col("port_x")) * res, -(F.col("stbd_x") - half) * res
    side = lambda d: F.sqrt(F.greatest(F.lit(0.0), r * r - d * d))
    return bottom.withColumns({"port_depth": port, "stbd_depth": stbd, "swath": side(port) + side(stbd)})


def statistics(column: str, prefix: str) -> list[Column]:
    """Mean, deviation of the population, greatest and least value, to one decimal; nulls do not count."""
    c = F.col(column).cast("double")
    made = {"mean": F.avg(c), "std": F.stddev_pop(c), "max": F.max(c), "min": F.min(c)}
    return [F.bround(x, 1).alias(f"{prefix}_{n}") for n, x in made.items()]


def statistic(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(LINE).agg(*statistics(column, column))


def area(pixels: DataFrame, res: float) -> DataFrame:
    """line, area: pixels above 1, in square metres."""
    return pixels.groupBy(LINE).agg((F.count_if(F.col("value") > 1) * res * res).alias("area"))


def density(rows: DataFrame, column: str = "gray", bins: int = BINS) -> DataFrame:
    """line, bin, edge, density, mu, sigma: bins of one width from the least to the greatest sample; the last one is closed."""
    v = rows.select(LINE, F.explode(column).alias("v")).select(LINE, F.col("v").cast("double").alias("v"))
    # Samples are counted by value first: sums that combine map-side.
    counts = v.groupBy(LINE, "v").agg(F.count("*").alias("n"))
    ends = v.groupBy(LINE).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mu"), F.stddev_pop("v").alias("sigma"), F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / width))).otherwise(0).cast("int")
    binned = counts.join(ends, LINE).groupBy(LINE, at.alias("bin")).agg(F.sum("n").alias("n"))
    all_bins = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).where("hi > lo")
    filled = all_bins.join(binned, [LINE, "bin"], "left")
    return filled.select(LINE, "bin", (F.col("lo") + F.col("bin") * width).alias("edge"), (F.coalesce("n", F.lit(0)) / F.col("total") / width).alias("density"), "mu", "sigma")


def normal(x: Column, mu: Column, sigma: Column) -> Column:
    z = (x - mu) / sigma
    return F.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * sigma)


def normal_difference(rows: DataFrame, column: str = "gray", shift: float = 0.0) -> DataFrame:
    """line, mu, sigma, difference: the sum over bins of how far densities are from the normal curve (moved by shift)."""
    d = density(rows, column)
    off = F.abs(F.col("density") - normal(F.col("edge") + shift, F.col("mu"), F.col("sigma")))
    return d.groupBy(LINE).agg(F.first("mu").alias("mu"), F.first("sigma").alias("sigma"), F.sum(off).alias("difference"))


def quartiles(df: DataFrame, column: str) -> DataFrame:
    """line, q1, median, q3 by linear interpolation: of a boxplot."""
    p = F.percentile(F.col(column), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.groupBy(LINE).agg(p.alias("_p")).select(LINE, *(F.col("_p")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))))


def histograms(images: dict[str, tuple[DataFrame, str, float]]) -> DataFrame:
    """line, image, bin, edge, density, expected, mu, sigma: of images (rows, column, shift) side by side.

    expected is the normal curve of an image's mean and deviation at a bin's edge, moved by its shift.
    """
    out = None
    for name, (rows, column, shift) in images.items():
        expected = normal(F.col("edge") + shift, F.col("mu"), F.col("sigma")).alias("expected")
        one = density(rows, column).select(LINE, F.lit(name).alias("image"), "bin", "edge", "density", expected, "mu", "sigma")
        out = one if out is None else out.unionByName(one)
    return out


def compared(found: DataFrame) -> DataFrame:
    """line, image, mu, sigma, difference: how far each histogram is from its normal curve."""
    return found.groupBy(LINE, "image").agg(F.first("mu").alias("mu"), F.first("sigma").alias("sigma"), F.sum(F.abs(F.col("density") - F.col("expected"))).alias("difference"))


#: Settings that the summary repeats, by the names of their columns.
SETTINGS = {
    "temperature": "temperature", "salinity": "salinity", "depth": "depth", "ph": "pH", "frequency": "frequency", "slant_range": "slant_range",
    "planed_speed": "planed_speed", "angle": "angle", "res": "res", "geo_epsg": "geo_epsg", "proj_epsg": "proj_epsg", "lambd": "lambd",
    "gradient_thred_factor": "gradient_thred_factor", "win_h": "win_h", "use_ab_line_correction": "use_ab_line_correction",
    "peak_factor": "peak_factor", "valley_std": "valley_std", "gray_enhance_method": "gray_enhance_method", "gaussian_kernel": "gaussian_kernel",
    "gain": "gain", "alpha": "alpha", "ratio": "ratio", "prob_thred": "prob_thred", "is_ns": "is_ns",
    "fish_trajectory_smooth_type": "fish_trajectory_smooth_type", "fish_trajectory_smooth_factor": "track_s", "angle_smooth_factor": "angle_s",
}


def summary(pings: DataFrame, track: DataFrame, bottom: DataFrame, pixels: DataFrame, params, lengths: DataFrame, smoothed: DataFrame | None = None, seconds: float | None = None) -> DataFrame:
    """One row a line: shape, settings, speed, positions, angles, depths on both sides, length, swath and area.

    The chosen angle's statistics are raw_angle_* (of pings) and smoothed_angle_* (of `smoothed`: line, ping and the angle); all are null
    for course over ground. Speeds are null where none was recorded. seconds: what the run took.
    """
    chosen = params.angle if params.angle in pings.columns else None
    nothing = [F.lit(None).cast("double").alias(f"{p}_{n}") for p in ("raw_angle", "smoothed_angle") for n in ("mean", "std", "max", "min")]
    speeds = pings if params.recorded_speed else pings.withColumn("speed", F.lit(None).cast("double"))
    shape = speeds.groupBy(LINE).agg(F.count("*").alias("ping_count"), F.max(F.size("bs")).alias("sample_count"), *statistics("speed", "speed"), *statistics("heading", "heading"), *(statistics(chosen, "raw_angle") if chosen else nothing[:4]))
    where = track.groupBy(LINE).agg(F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))
    wide = bottom.join(shape.select(LINE, "sample_count"), LINE)
    deep = depths(wide, F.col("sample_count"), params.slant_range)
    below = deep.groupBy(LINE).agg(*statistics("port_depth", "port_depth"), *statistics("stbd_depth", "stbd_depth"), F.bround(F.min("swath"), 1).alias("swath_min"), F.bround(F.max("swath"), 1).alias("swath_max"))
    parts = [where, below, lengths.select(LINE, F.bround("length", 1).alias("survey_length")), area(pixels, params.res)]
    if chosen and smoothed is not None:
        parts.append(smoothed.groupBy(LINE).agg(*statistics(chosen, "smoothed_angle")))
    out = shape
    for part in parts:
        out = out.join(part, LINE, "left")
    out = out if chosen and smoothed is not None else out.select("*", *nothing[4:])
    settings = {k: F.lit(getattr(params, v)) for k, v in SETTINGS.items()}
    settings["bottom_offset"] = F.array(*(F.lit(x) for x in params.bottom_offset))
    settings["time_cost"] = F.lit(seconds).cast("double")
    return out.withColumns(settings)
