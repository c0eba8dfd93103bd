"""Peaks of one-dimensional sequences in numpy, as small helpers for grouped jobs."""

from __future__ import annotations

import numpy as np


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Places of strict local maxima; a plateau counts once, at its middle (the lower one of two)."""
    if len(x) < 3:
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    level = x[starts]
    ends = np.append(starts[1:], len(x)) - 1
    up = np.concatenate([[False], level[1:] > level[:-1]])
    down = np.concatenate([level[:-1] > level[1:], [False]])
    return ((starts + ends) // 2)[up & down]


def far_apart(places: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    """Of the peaks, the highest first (later ones first among equals), those that no kept one is nearer to than `distance`."""
    kept = np.ones(len(places), bool)
    for i in np.argsort(height, kind="stable")[::-1]:
        if kept[i]:
            near = np.abs(places - places[i]) < distance
            near[i] = False
            kept &= ~near
    return places[kept]


def prominence(x: np.ndarray, peak: int) -> float:
    """Height over the higher one of the two lowest places between the peak and the next higher samples (or the ends)."""
    higher = np.flatnonzero(x > x[peak])
    left = higher[higher < peak]
    right = higher[higher > peak]
    a, b = (left[-1] + 1 if len(left) else 0), (right[0] if len(right) else len(x))
    return float(x[peak] - max(x[a : peak + 1].min(), x[peak:b].min()))


def find_peaks(x: np.ndarray, height: float | None = None, distance: int | None = None, least_prominence: float | None = None) -> np.ndarray:
    """Local maxima that pass, in this order, the height, the distance and the prominence."""
    places = local_maxima(x)
    if height is not None:
        places = places[x[places] >= height]
    if distance is not None:
        places = far_apart(places, x[places], distance)
    if least_prominence is not None:
        places = np.array([p for p in places if prominence(x, p) >= least_prominence], np.int64)
    return places


def relative_peaks(y: np.ndarray, threshold: float = 0.3, distance: int = 5) -> np.ndarray:
    """Local maxima above a share of the range, none within `distance` of a higher one."""
    if not len(y):
        return np.zeros(0, np.int64)
    places = local_maxima(y)
    places = places[y[places] > threshold * (y.max() - y.min()) + y.min()]
    return far_apart(places, y[places], distance + 1)
