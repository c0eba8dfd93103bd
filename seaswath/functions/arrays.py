"""Across-track operators: expressions on one ping's samples, which never shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Savitzky-Golay weights are (bottom - slope * k * k) / total for k from -half to half: (half, bottom, slope, total), fixed values.
SMOOTH_11, SMOOTH_51 = (5, 89, 5, 429), (25, 1949, 5, 44149)


def weights(kind: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """(place, integer numerator)."""
    half, bottom, slope, _ = kind
    return [(k, bottom - slope * k * k) for k in range(-half, half + 1)]


def half_width(bs: Column) -> Column:
    return F.floor(F.size(bs) / 2).cast("int")


def port(bs: Column) -> Column:
    """The port half, outward from nadir."""
    return F.reverse(F.slice(bs, F.lit(1), half_width(bs)))


def starboard(bs: Column) -> Column:
    return F.slice(bs, half_width(bs) + 1, half_width(bs))


def joined_halves(port_half: Column, starboard_half: Column) -> Column:
    """A waterfall row of halves that run outward."""
    return F.concat(F.reverse(port_half), starboard_half)


def convolved(rows: list, kind: tuple[int, int, int, int], divided: bool) -> list[np.ndarray]:
    """Smoothed samples of each row, times the weights' total unless divided; edges repeat. Whole numbers stay exact."""
    half, total = kind[0], kind[3] if divided else 1
    w = np.array([x for _, x in weights(kind)], np.float64)  # symmetric: no turning round
    arrays = [np.asarray(r, np.float64) for r in rows]
    return [np.convolve(np.pad(x, half, "edge"), w, "valid") / total if len(x) else x for x in arrays]


def _savgol(values: Column, kind: tuple[int, int, int, int], divided: bool) -> Column:
    @F.pandas_udf("array<double>")
    def smoothed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            known = series.notna()
            out = pd.Series([None] * len(series), dtype=object)
            out[known.to_numpy()] = pd.Series(convolved(list(series[known]), kind, divided), dtype=object).to_numpy()
            yield out

    return smoothed(values)


def savgol_numerators(values: Column, kind: tuple[int, int, int, int] = SMOOTH_11) -> Column:
    """Smoothed samples times the weights' total; null stays null. In Arrow batches: lambdas over arrays are not compiled."""
    return _savgol(values, kind, False)


def savgol(values: Column, kind: tuple[int, int, int, int] = SMOOTH_11) -> Column:
    return _savgol(values, kind, True)


def stride(values: Column, step: Column) -> Column:
    """Every step-th sample; of an odd number of these the last goes."""
    kept = F.filter(values, lambda _, i: F.pmod(i, step) == 0)
    return F.slice(kept, F.lit(1), F.size(kept) - F.pmod(F.size(kept), F.lit(2)))


def byte_clip(values: Column) -> Column:
    """Held to 0..255 and rounded half to even."""
    return F.transform(values, lambda v: F.bround(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v))).cast("smallint"))


def _byte(x: Column) -> Column:
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), x))).cast("smallint")


def log_stretch(v: Column, top: Column, gain: float = 200.0, c: float | Column = 256.0) -> Column:
    """c * log(1 + gain * v / top) / log(gain + 1), cut to a byte. v and top are already held to their range."""
    return _byte(c * F.log(1.0 + gain * v / top) / F.log(F.lit(gain + 1.0)))


def gamma_stretch(v: Column, top: Column, c: float = 256.0, r: float = 0.5) -> Column:
    return _byte(c * F.pow(v / top, F.lit(r)))


def linear(v: Column, low: Column, high: Column, new_min: float, new_max: float) -> Column:
    """v held to low..high, scaled to new_min..new_max, held to 1..255, cut to a whole number; a flat range gives new_min."""
    held = F.greatest(low, F.least(high, v))
    scaled = F.coalesce(F.try_divide((new_max - new_min) * (held - low), high - low), F.lit(0.0)) + new_min
    return F.floor(F.greatest(F.lit(1.0), F.least(F.lit(255.0), scaled))).cast("smallint")


def piecewise(v: Column, high: Column, top: Column, new_min: float, new_max: float) -> Column:
    """1 to high spread over new_min..100, high to the top over 100..new_max; values up to 1 become 1; cut to whole numbers."""
    upper = F.coalesce(F.try_divide(F.lit(new_max - 100.0), top - high), F.lit(0.0)) * (v - high) + 100.0
    lower = F.coalesce(F.try_divide(F.lit(100.0 - new_min), high - 1.0), F.lit(0.0)) * (v - 1.0) + new_min
    return F.when(v <= 1, 1).otherwise(F.floor(F.when(v > high, upper).otherwise(lower))).cast("smallint")
