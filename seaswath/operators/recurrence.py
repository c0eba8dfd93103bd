"""Linear recurrences along a line, dealt out in chunks.

y(i) = own * x(i) + the sum of weights[j] * y(i - 1 - j), and y(i) = x(i) for a line's first len(weights) pings. What
a chunk adds is an affine map of the values before it: its end from zeros, plus a power of one small matrix. The maps, one
row a chunk, are composed over each line; then every chunk adds the response to the values that it began with.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.operators.ordered import CHUNK, LINE

VECTORS = "array<array<double>>"


def companion(weights: tuple[float, ...]) -> np.ndarray:
    """What one step does to the last values, the latest first."""
    out = np.eye(len(weights), k=-1)
    out[0] = weights
    return out


@lru_cache(maxsize=8)
def responses(weights: tuple[float, ...], n: int) -> np.ndarray:
    """n rows: what each of the values before a chunk adds to its first n values."""
    step, out = companion(weights), np.zeros((n, len(weights)))
    row = np.eye(len(weights))[0]
    for i in range(n):
        row = row @ step
        out[i] = row
    return out


def from_zeros(x: np.ndarray, own: float, weights: tuple[float, ...], seeds: int) -> np.ndarray:
    """The values (rows of a vector) of a chunk before which all is zero; the first `seeds` rows are their own values."""
    y = own * x
    y[:seeds] = x[:seeds]
    for i in range(1, len(y)):
        if i >= seeds:
            for j, w in enumerate(weights[:i]):
                y[i] += w * y[i - 1 - j]
    return y


def recurrence(df: DataFrame, own: float, weights: tuple[float, ...], column: str = "x", size: int = CHUNK) -> DataFrame:
    """line, ping, y: of rows line, ping and `column`, an array of doubles of one length. Pings that are missing are passed over."""
    order = len(weights)
    size = max(size, order)  # a line's own first values lie in one chunk

    @F.pandas_udf(VECTORS)
    def alone(vectors: pd.Series, seeds: pd.Series) -> pd.Series:
        return pd.Series([from_zeros(np.stack(list(v)), own, weights, int(n)).tolist() for v, n in zip(vectors, seeds, strict=True)], dtype=object)

    def composed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_chunk")
        state, before = 0.0, []
        for n, end in zip(group["n"], group["end"], strict=True):
            end = np.stack(list(end))[::-1]
            here = np.zeros((order, end.shape[1]))
            here[: len(end)] = end
            before.append(np.broadcast_to(state, here.shape).tolist())
            state = here + np.linalg.matrix_power(companion(weights), int(n)) @ np.broadcast_to(state, here.shape)
        return group[[LINE, "_chunk"]].assign(before=before)

    @F.pandas_udf(VECTORS)
    def added(vectors: pd.Series, before: pd.Series) -> pd.Series:
        return pd.Series([(np.stack(list(v)) + responses(weights, len(v)) @ np.stack(list(b))).tolist() for v, b in zip(vectors, before, strict=True)], dtype=object)

    rows = df.select(LINE, "ping", F.floor(F.col("ping") / size).cast("int").alias("_chunk"), F.col(column).alias("x"))
    chunks = rows.groupBy(LINE, "_chunk").agg(F.array_sort(F.collect_list(F.struct("ping", "x"))).alias("r"))
    seeds = F.size(F.filter("r", lambda e: e["ping"] < order))
    parts = chunks.select(LINE, "_chunk", F.col("r.ping").alias("pings"), alone(F.col("r.x"), seeds).alias("y"))
    ends = parts.select(LINE, "_chunk", F.size("y").alias("n"), F.slice("y", -F.least(F.lit(order), F.size("y")), F.lit(order)).alias("end"))
    kind = df.schema[LINE].dataType.simpleString()
    before = ends.groupBy(LINE).applyInPandas(composed, f"{LINE} {kind}, _chunk int, before {VECTORS}")
    done = parts.join(before, [LINE, "_chunk"]).select(LINE, F.explode(F.arrays_zip("pings", added("y", "before").alias("y"))).alias("e"))
    return done.select(LINE, F.col("e.pings").alias("ping"), F.col("e.y").alias("y"))
