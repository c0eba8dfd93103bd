"""Repair of humps in the bottom line: peaks of the port side, the valleys round each, a straight line between.

Peaks need their whole neighbourhood of REACH pings, valleys as much on either side of a peak; a line is
dealt out in chunks with that much of their neighbours, and each chunk repairs the humps that peak in it.
A hump without quiet valleys on both sides stays as it is. Starboard mirrors port.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.functions.peaks import find_peaks, relative_peaks
from seaswath.operators.ordered import LINE, halo

REACH, DISTANCE, PROMINENCE, OUTER = 300, 50, 20.0, 10
#: Pings of other chunks that a chunk sees: a peak's own reach on top of that of the humps next to it.
HALO = 2 * REACH + OUTER


def peak_height(mean_x: float, n_sample: int, factor: float) -> int:
    """The least port_x of a peak: that share of the mean distance from nadir."""
    return int(n_sample / 2 - int(n_sample / 2 - mean_x) * factor)


def valley(x: np.ndarray, peak: int, side: int, quiet: float) -> int | None:
    """Of the valleys on one side of a peak, going outward, the second after the first quiet stretch between two."""
    a, b = max(0, peak - REACH), min(len(x), peak + REACH)
    found = a + relative_peaks(-x[a:b])
    outward = found[found > peak] if side > 0 else found[found < peak][::-1]
    for j in range(len(outward) - 1):
        low, high = sorted((outward[j], outward[j + 1]))
        if x[low:high].std() < quiet:
            return int(outward[j + 2]) if j + 2 < len(outward) else None
    return None


def repaired(x: np.ndarray, mean_x: float, n_sample: int, factor: float, quiet: float) -> tuple[np.ndarray, np.ndarray]:
    """New x, and for each place the peak it was repaired for (-1: none)."""
    out, of = x.copy(), np.full(len(x), -1)
    for peak in find_peaks(x, peak_height(mean_x, n_sample, factor), DISTANCE, PROMINENCE):
        left, right = valley(x, peak, -1, quiet), valley(x, peak, 1, quiet)
        if left is None or right is None or right - left < 2:
            continue
        inner = np.arange(left + 1, right)
        out[inner] = np.interp(inner, [left, right], [out[left], out[right]]).astype(np.int64)
        of[inner] = peak
    return out, of


def sized(bottom: DataFrame, n_sample: int | DataFrame) -> DataFrame:
    """line, _mean (of port_x), _n: the width of the line's rows, given as a number for all or as line, n_sample."""
    means = bottom.groupBy(LINE).agg(F.avg("port_x").alias("_mean"))
    if isinstance(n_sample, DataFrame):
        return means.join(n_sample.select(LINE, F.col("n_sample").cast("int").alias("_n")), LINE)
    return means.withColumn("_n", F.lit(n_sample))


def repair(bottom: DataFrame, n_sample: int | DataFrame, factor: float = 0.7, quiet: float = 5.0) -> DataFrame:
    """bottom with the humps replaced."""
    chunks = halo(bottom.select(LINE, "ping", "port_x", "stbd_x"), HALO, HALO).join(sized(bottom, n_sample), LINE)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ping").reset_index(drop=True)
        x, width = group["port_x"].to_numpy(np.int64), int(group["_n"].iloc[0])
        new, of = repaired(x, float(group["_mean"].iloc[0]), width, factor, quiet)
        out = group[[LINE, "ping", "port_x", "stbd_x"]].copy()
        hit = of >= 0
        out["port_x"] = np.where(hit, new, x)
        out["stbd_x"] = np.where(hit, width - new, group["stbd_x"])
        return out[group["_own"].to_numpy()]

    return chunks.groupBy(LINE, "_chunk").applyInPandas(run, f"{LINE} {bottom.schema[LINE].dataType.simpleString()}, ping int, port_x int, stbd_x int")


def peaks(bottom: DataFrame, n_sample: int | DataFrame, factor: float = 0.7) -> DataFrame:
    """line, ping, port_x of the peaks."""
    chunks = halo(bottom.select(LINE, "ping", "port_x"), HALO, HALO).join(sized(bottom, n_sample), LINE)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ping").reset_index(drop=True)
        found = find_peaks(group["port_x"].to_numpy(np.int64), peak_height(float(group["_mean"].iloc[0]), int(group["_n"].iloc[0]), factor), DISTANCE, PROMINENCE)
        at = group.iloc[found]
        return at[at["_own"]][[LINE, "ping", "port_x"]]

    return chunks.groupBy(LINE, "_chunk").applyInPandas(run, f"{LINE} {bottom.schema[LINE].dataType.simpleString()}, ping int, port_x int")
