"""Across-track gain: each column's mean brought to the side's mean, in one pass or two, and local contrast.

Factors belong to a line and are one array of its width; column means are summed map-side. Columns beyond
the least ground width take the mean of the last column inside it. A column of mean zero gets gain zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seaswath.functions import arrays
from seaswath.functions.peaks import find_peaks
from seaswath.operators import stretch
from seaswath.operators.ordered import LINE, halo
from seaswath.sources.tables import stored, workspace

PROMINENCE = 50.0
DEGREE = 9


def column_means(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, means and sums (arrays of the line's width, by column), n (pings)."""
    each = rows.select(LINE, F.posexplode(column).alias("k", "v")).groupBy(LINE, "k").agg(F.avg("v").alias("mean"), F.sum("v").alias("sum"), F.count("v").alias("n"))
    by_column = F.array_sort(F.collect_list(F.struct("k", "mean", "sum", "n")))  # as many entries as the line has columns
    return each.groupBy(LINE).agg(by_column.alias("_c")).select(LINE, F.col("_c.mean").alias("means"), F.col("_c.sum").alias("sums"), F.col("_c.n").alias("ns"))


def _side_mean(first: Column, n: Column) -> Column:
    total = lambda name: F.aggregate(F.slice(F.col(name).cast("array<double>"), first, n), F.lit(0.0), lambda a, b: a + b)
    return F.try_divide(total("sums"), total("ns"))


def raw_factors(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, factor: unsmoothed, in the order of the row."""
    widths = rows.groupBy(LINE).agg(F.min(F.least("min_port_width", "min_stbd_width")).alias("_w"))
    found = column_means(rows, column).join(widths, LINE)
    h = F.floor(F.size("means") / 2).cast("int")
    found = found.withColumn("_h", h).withColumn("_port", _side_mean(F.lit(1), h)).withColumn("_stbd", _side_mean(h + 1, h))

    def factor(_: Column, k: Column) -> Column:
        h, edge = F.col("_h"), F.greatest(F.lit(0), F.col("_w") - 1)
        j = F.least(F.when(k < h, h - 1 - k).otherwise(k - h), edge)
        mean = F.get("means", F.when(k < h, h - 1 - j).otherwise(h + j))
        return F.coalesce(F.when(mean != 0, F.when(k < h, F.col("_port")).otherwise(F.col("_stbd")) / mean), F.lit(0.0))

    return found.select(LINE, F.transform("means", factor).alias("factor"))


def factors(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, factor: smoothed over 51 columns. rows have min_port_width and min_stbd_width."""
    return raw_factors(rows, column).withColumn("factor", arrays.savgol(F.col("factor"), arrays.SMOOTH_51))


def polynomial_factors(rows: DataFrame, column: str = "bs") -> DataFrame:
    """line, factor: a polynomial of degree DEGREE through the unsmoothed factors (one array a line)."""

    @F.pandas_udf("array<double>")
    def fitted(series: pd.Series) -> pd.Series:
        out = []
        for values in series:
            y = np.asarray(values, np.float64)
            out.append(np.polynomial.Polynomial.fit(np.arange(len(y)), y, min(DEGREE, max(0, len(y) - 1)))(np.arange(len(y))))
        return pd.Series(out, dtype=object)

    return raw_factors(rows, column).withColumn("factor", fitted("factor"))


def applied(rows: DataFrame, found: DataFrame, gain: float = 1.0, column: str = "bs", out: str = "bs") -> DataFrame:
    joined = rows.join(found.select(LINE, F.col("factor").alias("_factor")), LINE)
    return joined.withColumn(out, F.zip_with(column, "_factor", lambda v, f: v * f * gain)).drop("_factor")


def statistic(rows: DataFrame, ratio: float = 0.02, **_) -> DataFrame:
    """rows with bs times factor, and gray."""
    return stretch.linear_stretch(applied(rows, factors(rows)), ratio)


def statistic_fit(rows: DataFrame, gain: float = 50.0) -> DataFrame:
    """bs times polynomial factor times gain; gray cut to a byte."""
    out = applied(rows, polynomial_factors(rows), gain)
    return out.withColumn("gray", F.transform("bs", lambda v: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v))).cast("smallint")))


def quiet(x: np.ndarray, share: float) -> bool:
    """Whether a ping shows no object: no prominent peak after smoothing, or a mean above that share of the highest one. Without samples it shows none."""
    if not len(x):
        return True
    half, bottom, slope, total = arrays.SMOOTH_11
    weights = (bottom - slope * np.arange(-half, half + 1) ** 2) / total
    x = np.convolve(np.pad(x, half, "edge"), weights, "valid")
    peaks = find_peaks(x, height=x.min() + PROMINENCE, least_prominence=PROMINENCE)
    return len(peaks) == 0 or bool(x.mean() / x[peaks].max() > share)


def no_object(values: Column, share: float) -> Column:
    @F.pandas_udf("boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([v is not None and quiet(np.asarray(v, np.float64), share) for v in series], dtype="boolean")

    return judged(values)


def no_object_pings(rows: DataFrame, share: float = 0.3, gain: float = 10.0, coarse: DataFrame | None = None) -> DataFrame:
    """The rows whose coarsely levelled ping shows no object; bs stays as it was. coarse: factors(rows), where they are at hand."""
    levelled = applied(rows, factors(rows) if coarse is None else coarse, gain, out="_coarse")
    return levelled.where(no_object(F.col("_coarse"), share)).drop("_coarse")


def coarse2fine(rows: DataFrame, ratio: float = 0.02, prob_thred: float = 0.3, **_) -> DataFrame:
    """Factors learned a second time, from the pings without objects alone; a line without such pings keeps the coarse ones.

    Both tables of factors have one row a line and are written, since they are read several times.
    """
    folder = workspace(rows.sparkSession)
    coarse = stored(factors(rows), folder, "coarse")
    fine = factors(no_object_pings(rows, prob_thred, coarse=coarse))
    best = coarse.select(LINE, F.col("factor").alias("_first")).join(fine, LINE, "left").select(LINE, F.coalesce("factor", "_first").alias("factor"))
    return stretch.linear_stretch(applied(rows, stored(best, folder, "factors")), ratio)


def gaussian(sigma: float) -> np.ndarray:
    """Weights of a Gaussian cut at four deviations, adding up to one."""
    radius = int(round(sigma * 4 * 2 + 1) | 1) // 2
    w = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2.0 * sigma**2))
    return w / w.sum()


def convolved(x: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """'valid' convolution along an axis by Fourier transform."""
    n = x.shape[axis] + len(weights) - 1
    shape = [1, 1]
    shape[axis] = -1
    got = np.fft.irfft(np.fft.rfft(x, n, axis) * np.fft.rfft(weights, n).reshape(shape), n, axis)
    return np.take(got, np.arange(len(weights) - 1, x.shape[axis]), axis)


def reflected(i: np.ndarray, n: int) -> np.ndarray:
    """Places mirrored at the first and last of n, which do not repeat."""
    period = max(1, 2 * (n - 1))
    i = np.mod(i, period)
    return np.minimum(i, period - i)


def blurred(pings: DataFrame, sigma: float, chunk: int = 512) -> DataFrame:
    """pings with `blur`: a two-dimensional Gaussian of bs, mirrored at the edges. All rows of a line are of one width."""
    weights = gaussian(sigma)
    radius = len(weights) // 2
    ends = pings.groupBy(LINE).agg((F.max("ping") + 1).alias("_n"))
    dealt = halo(pings.select(LINE, "ping", "bs"), radius, radius, max(chunk, radius)).join(ends, LINE)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ping")
        x, n = np.stack(group["bs"].to_numpy()).astype(np.float64), int(group["_n"].iloc[0])
        pings, own = group["ping"].to_numpy(), group["_own"].to_numpy()
        if not own.any():
            return pd.DataFrame({LINE: [], "ping": [], "blur": []})
        x = convolved(x[:, reflected(np.arange(-radius, x.shape[1] + radius), x.shape[1])], weights, 1)
        first, last = pings[own].min(), pings[own].max()
        wanted = reflected(np.arange(first - radius, last + radius + 1), n)
        out = convolved(x[np.searchsorted(pings, wanted)], weights, 0)
        return pd.DataFrame({LINE: group[LINE].iloc[0], "ping": np.arange(first, last + 1, dtype=np.int32), "blur": list(out)})

    found = dealt.groupBy(LINE, "_chunk").applyInPandas(run, f"{LINE} {pings.schema[LINE].dataType.simpleString()}, ping int, blur array<double>")
    return pings.join(found, [LINE, "ping"])


def retinex(rows: DataFrame, gaussian_kernel: float = 50.0, gain: float = 10.0, alpha: float = 0.05, **_) -> DataFrame:
    """bs over its surroundings: gain * bs / (blur + alpha), and gray cut to a byte."""
    out = blurred(rows, gaussian_kernel).withColumn("bs", F.zip_with("bs", "blur", lambda v, b: F.coalesce(F.try_divide(v * gain, b + alpha), F.lit(0.0)))).drop("blur")
    return out.withColumn("gray", F.transform("bs", lambda v: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v))).cast("smallint")))


#: By the name that the command line gives; each takes rows and keyword settings.
METHODS: dict[str, Callable[..., DataFrame]] = {"retinex": retinex, "statistic": statistic, "coarse2fine": coarse2fine}


def enhanced(rows: DataFrame, method: str, **settings) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown gray enhancement {method}: one of {sorted(METHODS)}")
    return METHODS[method](rows, **settings)
