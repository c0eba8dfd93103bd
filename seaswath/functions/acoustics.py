"""Absorption of sound in sea water (dB/m) and time-varying gain, as column expressions.

Coefficients are fixed values from the published formulas: Ainslie and McColm (1998), Francois and
Garrison (1982), and the profiler manual's formula. Null inputs give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _polynomial(x: Column, *coefficients: float) -> Column:
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def _relaxation(f: Column, at: Column) -> Column:
    """Response of a process that relaxes at one frequency: at * f^2 / (at^2 + f^2)."""
    return at * f * f / (at * at + f * f)


def _power_of_ten(x: Column) -> Column:
    return F.pow(F.lit(10.0), x)


def ainslie_mccolm(hz: Column, t: Column, s: Column, pressure: Column, ph: Column) -> Column:
    """Pressure in dbar stands for depth in metres; meant for 100 Hz to 1 MHz, above that it extrapolates."""
    f, km = hz / 1000.0, pressure / 1000.0
    boric = 0.106 * _relaxation(f, 0.78 * F.sqrt(s / 35.0) * F.exp(t / 26.0)) * F.exp((ph - 8.0) / 0.56)
    magnesium = 0.52 * (1.0 + t / 43.0) * (s / 35.0) * _relaxation(f, 42.0 * F.exp(t / 17.0)) * F.exp(-km / 6.0)
    return (boric + magnesium + 0.00049 * f * f * F.exp(-(t / 27.0 + km))) / 1000.0


def francois_garrison(hz: Column, t: Column, s: Column, pressure: Column, ph: Column, sound_speed: Column | None = None) -> Column:
    f = hz / 1000.0
    c = sound_speed if sound_speed is not None else 1412.0 + 3.21 * t + 1.19 * s + 0.0167 * pressure
    kelvin = t + 273.0
    boric = 8.86 / c * _power_of_ten(0.78 * ph - 5.0) * _relaxation(f, 2.8 * F.sqrt(s / 35.0) * _power_of_ten(4.0 - 1245.0 / kelvin))
    relaxed = 8.17 * _power_of_ten(8.0 - 1990.0 / kelvin) / (1.0 + 0.0018 * (s - 35.0))
    magnesium = 21.44 * s / c * (1.0 + 0.025 * t) * _polynomial(pressure, 1.0, -1.37e-4, 6.2e-9) * _relaxation(f, relaxed)
    cold, warm = _polynomial(t, 4.937e-4, -2.59e-5, 9.11e-7, -1.5e-8), _polynomial(t, 3.964e-4, -1.146e-5, 1.45e-7, -6.5e-10)
    water = F.when(t < 20, cold).otherwise(warm) * _polynomial(pressure, 1.0, -3.83e-5, 4.9e-10) * f * f
    return (boric + magnesium + water) / 1000.0


def profiler(hz: Column, t: Column, s: Column, pressure: Column, ph: Column | None = None) -> Column:
    """Without salt only water itself absorbs; pH plays no part."""
    kelvin, k = t + 273.0, 1.0 + pressure / 10.0
    a = 8.95e-8 * _polynomial(t, 1.0, 2.29e-2, -5.08e-4)
    b = s / 35.0 * 4.88e-7 * (1.0 + 0.0134 * t) * _polynomial(k, 1.0, -0.00103, 3.7e-7)
    c = 4.86e-13 * _polynomial(t, 1.0, -0.042, 8.53e-4, -6.23e-6) * _polynomial(k, 1.0, -3.84e-4, 7.57e-8)
    salt = a * _relaxation(hz, 1320.0 * kelvin * F.exp(-1700.0 / kelvin)) + b * _relaxation(hz, 1.55e7 * kelvin * F.exp(-3052.0 / kelvin))
    return F.when(s == 0, 0.0).otherwise(salt) + c * hz * hz


FORMULAS = {"AM": ainslie_mccolm, "FG": francois_garrison, "AZFP": profiler}


def absorption(hz, t=27.0, s=35.0, pressure=10.0, ph=8.1, formula: str = "AM") -> Column:
    """Numbers or columns; an unknown formula raises."""
    if formula not in FORMULAS:
        raise ValueError(f"unknown formula {formula}: one of {sorted(FORMULAS)}")
    return FORMULAS[formula](*(x if isinstance(x, Column) else F.lit(float(x)) for x in (hz, t, s, pressure, ph)))


def tvg_factor(j: Column, n_sample: Column, slant_range: float, lambd: float, alpha: Column) -> Column:
    """Gain of the sample j places from nadir on either side: lambd*log10(r) + 2*alpha*r, none at nadir, never negative.

    r is measured with the full width (both sides), so it is half the true range.
    """
    r = F.lit(float(slant_range)) / n_sample * j
    return F.when(j <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), lambd * F.log10(r) + 2.0 * alpha * r))


def tvg(bs: Column, slant_range: float, lambd: float, alpha: Column) -> Column:
    """A waterfall row multiplied by its gain; port is the first half, with nadir at the centre."""
    n = F.size(bs)
    h = F.floor(n / 2).cast("int")
    return F.transform(bs, lambda v, k: v * tvg_factor(F.when(k < h, h - 1 - k).otherwise(k - h), n, slant_range, lambd, alpha))
