"""Gauss-Krueger projection (transverse Mercator, scale 1) and its inverse as column expressions.

A four-term series in the third flattening; eastings carry the zone as a prefix of millions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Axis and inverse flattening by geographic EPSG code.
ELLIPSOIDS = {4490: (6378137.0, 298.257222101), 4326: (6378137.0, 298.257223563)}
#: The six-degree zone's projected EPSG codes begin here, for zone 13 (central meridian 75 degrees).
FIRST_EPSG, FIRST_ZONE = 4491, 13


@dataclass(frozen=True)
class Zone:
    number: int

    @property
    def meridian(self) -> float:
        return 6.0 * self.number - 3.0

    @property
    def false_easting(self) -> float:
        return self.number * 1e6 + 5e5


def zone_of(proj_epsg: int) -> Zone:
    number = proj_epsg - FIRST_EPSG + FIRST_ZONE
    if not 13 <= number <= 23:
        raise ValueError(f"unknown projected EPSG code {proj_epsg}")
    return Zone(number)


def _series(geo_epsg: int):
    """Radius, eccentricity, and the coefficients of the forward and the inverse series, from Krueger's formulas in n."""
    if geo_epsg not in ELLIPSOIDS:
        raise ValueError(f"unknown geographic EPSG code {geo_epsg}: one of {sorted(ELLIPSOIDS)}")
    a, inverse = ELLIPSOIDS[geo_epsg]
    f = 1 / inverse
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [
        n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
        13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
        61 / 240 * n**3 - 103 / 140 * n**4,
        49561 / 161280 * n**4,
    ]
    backward = [
        n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4,
        1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4,
        17 / 480 * n**3 - 37 / 840 * n**4,
        4397 / 161280 * n**4,
    ]
    return radius, math.sqrt(f * (2 - f)), forward, backward


def project(lat: Column, lon: Column, geo_epsg: int = 4490, proj_epsg: int = 4499) -> tuple[Column, Column]:
    """(easting, northing) in metres of degrees."""
    radius, e, forward, _ = _series(geo_epsg)
    zone = zone_of(proj_epsg)
    sine, turn = F.sin(F.radians(lat)), F.radians(lon - zone.meridian)
    conformal = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    north, east = F.atan2(conformal, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1.0 + conformal * conformal))
    x, y = east, north
    for j, c in enumerate(forward, 1):
        x = x + c * F.cos(2.0 * j * north) * F.sinh(2.0 * j * east)
        y = y + c * F.sin(2.0 * j * north) * F.cosh(2.0 * j * east)
    return zone.false_easting + radius * x, radius * y


def unproject(x: Column, y: Column, geo_epsg: int = 4490, proj_epsg: int = 4499, rounds: int = 4) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees of metres; the latitude by fixed Newton steps on the conformal one."""
    radius, e, _, backward = _series(geo_epsg)
    zone = zone_of(proj_epsg)
    north0, east0 = y / radius, (x - zone.false_easting) / radius
    north, east = north0, east0
    for j, c in enumerate(backward, 1):
        north = north - c * F.sin(2.0 * j * north0) * F.cosh(2.0 * j * east0)
        east = east - c * F.cos(2.0 * j * north0) * F.sinh(2.0 * j * east0)
    isometric = F.asinh(F.sin(north) / F.sqrt(F.pow(F.sinh(east), 2) + F.pow(F.cos(north), 2)))
    sine = F.tanh(isometric)
    for _ in range(rounds):  # fixed point: contracts by e^2 each time
        sine = F.tanh(isometric + e * F.atanh(e * sine))
    return F.degrees(F.asin(sine)), zone.meridian + F.degrees(F.atan2(F.sinh(east), F.cos(north)))
