"""The bottom line of pings that arrive over many micro-batches, the same as the batch job finds.

State is kept by line: the raw rows whose neighbours are still to come, the first thresholds, and the coarse bottom of as many pings
as the corrections and the smoothing look back on. A ping's bottom is given once everything that it depends on has come: the
next ping for its gradient, then two corrections of `win_h` pings and a smoothing of five. What remains is given when a line
ends: by a row whose column `last` is true, or, with `patience`, when no ping has come for so long. Pings may come in any order and more than once
(the first one counts); those that are missing when a line ends are passed over, and later ones of an ended line begin it anew.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seaswath.functions import arrays
from seaswath.operators.bottom import TOTAL
from seaswath.operators.ordered import LINE

SMOOTHED = 5


def halves(bs: np.ndarray) -> np.ndarray:
    """Both halves outward: port, starboard."""
    h = len(bs) // 2
    return np.stack([bs[:h][::-1], bs[h : 2 * h]])


def smooth_rows(rows: np.ndarray) -> np.ndarray:
    return np.stack(arrays.convolved(list(rows), arrays.SMOOTH_11, False))


def gradients(before: np.ndarray | None, here: np.ndarray, after: np.ndarray | None) -> np.ndarray:
    """The stencil's steps outward on both sides; before and here are raw halves that are smoothed, after stays raw."""
    out = 2.0 * np.diff(smooth_rows(here))
    out = out + np.diff(smooth_rows(before)) if before is not None else out
    return (out + TOTAL * np.diff(after) if after is not None else out)[:, : here.shape[1] - 2]


def nearest(port: np.ndarray, stbd: np.ndarray) -> tuple[int, int]:
    """The candidates nearest to each other; ties to the smaller port one, then the smaller starboard one."""
    apart = np.abs(port[:, None] - stbd[None, :])
    i, j = np.unravel_index(int(apart.argmin()), apart.shape)
    return int(port[i]), int(stbd[j])


class Thresholds:
    """A ping's thresholds by its greatest gradients, in the order of pings."""

    def __init__(self, factor: float, compat: bool):
        self.factor, self.compat, self.stored = factor, compat, []

    def of(self, ping: int, most: np.ndarray) -> np.ndarray:
        share = most * self.factor
        if self.compat:
            if ping < 4:
                self.stored.append(share[1])
                return share
            first = self.stored
            at = [first[min(ping - i, 3)] for i in range(1, 5)]
            return np.array([(share[1] + at[0] + at[1] + at[2] + at[3]) / 5.0, first[3]])
        out = share if ping < 4 else 0.2 * share + 0.2 * self.stored[-1] + 0.2 * self.stored[-2] + 0.2 * self.stored[-3] + 0.2 * self.stored[-4]
        self.stored = [*self.stored[-3:], out]
        return out


def corrected(x: np.ndarray, reach: int) -> np.ndarray:
    """Outliers replaced by their neighbours' weighted mean, as in operators.bottom, over a whole stretch."""
    n = len(x)
    wide = np.concatenate([np.full(reach, np.nan), x, np.full(reach, np.nan)])
    total, weight, near = np.zeros(n), np.zeros(n), []
    for j in range(1, reach + 1):
        later, earlier, share = wide[reach + j : reach + j + n], wide[reach - j : reach - j + n], 1 - j / reach
        total = total + np.nan_to_num(later * share) + np.nan_to_num(earlier * share)
        known = (~np.isnan(later)).astype(int) + ~np.isnan(earlier)
        weight = weight + np.where(known == 2, 2 * share, np.where(known == 1, share, 0.0))
        near += [later, earlier]
    near = np.stack(near, 1)
    out = x.copy()
    for i in range(n):
        seen = near[i][~np.isnan(near[i])]
        if len(seen) and weight[i]:
            mean = sum(seen.tolist(), 0.0) / len(seen)
            spread = np.sqrt(sum(((v - mean) * (v - mean) for v in seen.tolist()), 0.0) / len(seen))
            expected = total[i] / weight[i]
            if not abs(x[i] - expected) <= spread:
                out[i] = np.floor(expected)
    return out


def smoothed(x: np.ndarray) -> np.ndarray:
    half = arrays.SMOOTH_11[0]
    wide = np.pad(x, half, "edge")
    return np.floor(sum(c * wide[half + k : half + k + len(x)] for k, c in arrays.weights(arrays.SMOOTH_11)) / TOTAL)


class Line:
    """What is known of a line. `coarse`: rows of port and starboard from ping `begin` on; `given`: pings whose bottom is out."""

    def __init__(self, factor: float, win_h: int, compat: bool):
        self.win_h, self.waiting, self.rows = win_h, {}, []
        self.thresholds, self.coarse, self.begin, self.given, self.next = Thresholds(factor, compat), [], 0, 0, 0
        self.before: np.ndarray | None = None

    def add(self, ping: int, bs: np.ndarray) -> None:
        if ping >= self.next:
            self.waiting.setdefault(ping, bs)

    def _coarse(self, after: np.ndarray | None) -> None:
        """The bottom of the row at hand, by the rows around it."""
        here = self.rows.pop(0)
        g = gradients(self.before, here, after)
        limits = self.thresholds.of(self.begin + len(self.coarse), g.max(1))
        found = [np.flatnonzero(side >= limit) + 1 if (side >= limit).any() else np.array([side.argmax() + 1]) for side, limit in zip(g, limits, strict=True)]
        port, stbd = nearest(*found)
        h = here.shape[1]
        self.coarse.append((h - 1 - port, h - 1 + stbd))
        self.before = here

    def advance(self, ended: bool) -> list[tuple[int, int, int]]:
        """(ping, port_x, stbd_x) of the pings that became final."""
        while self.next in self.waiting or (ended and self.waiting):
            bs = self.waiting.pop(self.next if self.next in self.waiting else min(self.waiting))
            self.next += 1
            self.rows.append(halves(bs))
            if len(self.rows) == 2:
                self._coarse(self.rows[1])
        if ended and self.rows:
            self._coarse(None)
        n = self.begin + len(self.coarse)
        reach = 2 * self.win_h + SMOOTHED
        until = n if ended else n - reach
        if until <= self.given:
            return []
        values = np.array(self.coarse, np.float64)
        sides = []
        for x in values.T:
            twice = corrected(corrected(x, self.win_h), self.win_h)
            sides.append(smoothed(twice) if n >= 11 else twice)
        out = [(p, int(sides[0][p - self.begin]), int(sides[1][p - self.begin])) for p in range(self.given, until)]
        self.given = until
        # As many pings stay as what follows looks back on; at the line's beginning all do.
        drop = max(0, self.given - reach - self.begin)
        self.coarse, self.begin = self.coarse[drop:], self.begin + drop
        return out


def detect(pings: DataFrame, factor: float = 0.1, win_h: int = 10, compat: bool = True, patience: int | None = None) -> DataFrame:
    """line, ping, port_x, stbd_x of a stream of pings (line, ping, bs, and `last` if it has it); patience: milliseconds.

    Rows of fewer than three samples a side raise. To be written in append mode. With patience, batches without data go on, so that a
    trigger that takes what is there does not end by itself.
    """
    rows = pings if "last" in pings.columns else pings.withColumn("last", F.lit(False))
    kind = pings.schema[LINE].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        line = pickle.loads(state.get[0]) if state.exists else Line(factor, win_h, compat)
        ended = state.hasTimedOut
        if not ended:
            for batch in batches:
                for ping, bs, last in zip(batch["ping"], batch["bs"], batch["last"], strict=True):
                    line.add(int(ping), np.asarray(bs, np.float64))
                    ended = ended or bool(last)
        found = line.advance(ended)
        if ended:
            state.remove()
        else:
            state.update((pickle.dumps(line),))
            if patience is not None:
                state.setTimeoutDuration(patience)
        yield pd.DataFrame([(key[0], *r) for r in found], columns=[LINE, "ping", "port_x", "stbd_x"])

    return rows.select(LINE, "ping", "bs", "last").groupBy(LINE).applyInPandasWithState(step, f"{LINE} {kind}, ping int, port_x int, stbd_x int", "line binary", "append", GroupStateTimeout.NoTimeout if patience is None else GroupStateTimeout.ProcessingTimeTimeout)
