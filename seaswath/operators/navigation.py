"""Navigation of a line: filling gaps, repeated fixes, interpolation, bearings, lengths, smoothing.

A table has line, ping (dense from 0) and its columns. Zeros stand for missing values. Lines with no
valid value at all keep their zeros as null. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seaswath.functions.projection import project
from seaswath.functions.spline import SPANS
from seaswath.operators import smoothing
from seaswath.operators.ordered import LINE, filled, halo, in_chunk, owned, running_sum
from seaswath.sources.tables import stored, workspace


def fill_zeros(df: DataFrame, column: str) -> DataFrame:
    """Zeros and nulls take the last value before them, leading ones the first after."""
    valid = F.col(column).isNotNull() & (F.col(column) != 0)
    return filled(df, valid, [column])


def fill_positions(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """A position is missing where both coordinates are zero (or either is null)."""
    valid = F.col(lon).isNotNull() & F.col(lat).isNotNull() & ((F.col(lon) != 0) | (F.col(lat) != 0))
    return filled(df, valid, [lon, lat])


def changed(columns: list[str]) -> Column:
    """Whether a row (in a chunk) differs from the one before; the first of a line does."""
    w = in_chunk()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    return (F.col("ping") == 0) | ~same


def marked_fixes(df: DataFrame, columns: list[str], name: str = "is_fix") -> DataFrame:
    return owned(halo(df, 1, 0).withColumn(name, changed(columns)))


def without_repeats(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that differ from the one before them in the line."""
    return marked_fixes(df, columns, "_fix").where("_fix").drop("_fix")


def interpolate_between_fixes(df: DataFrame, columns: list[str], is_fix: Column) -> DataFrame:
    """Between kept fixes columns run linearly; after the last the slope goes on; a single fix holds.

    Pings with the number of their fix are written once; a window over fixes alone gives each its neighbours, and pings
    join their fix by its number.
    """
    narrow = df.select(LINE, "ping", *columns, is_fix.alias("_fix"))
    counted = stored(running_sum(narrow, F.col("_fix").cast("long"), "_q"), workspace(df.sparkSession), "fixes")
    w = in_chunk()
    fixes = counted.where("_fix").select(LINE, F.col("_q").cast("int").alias("ping"), F.struct(F.col("ping").alias("p"), *(F.col(c).alias(f"v{i}") for i, c in enumerate(columns))).alias("_at"))
    linked = owned(halo(fixes, 1, 1).withColumns({"_next": F.lead("_at").over(w), "_last": F.lag("_at").over(w)}))
    linked = linked.select(LINE, F.col("ping").cast("long").alias("_q"), "_at", "_next", "_last")
    # Pings before the first fix go with it.
    rows = counted.withColumn("_q", F.greatest(F.col("_q"), F.lit(1).cast("long"))).join(linked, [LINE, "_q"], "left")
    at, after, before, new = F.col("_at"), F.col("_next"), F.col("_last"), []
    for i, c in enumerate(columns):
        v = f"v{i}"
        onward = F.when(after.isNotNull(), (after[v] - at[v]) / (after["p"] - at["p"])).when(before.isNotNull(), (at[v] - before[v]) / (at["p"] - before["p"])).otherwise(F.lit(0.0))
        new.append((at[v] + (F.col("ping") - at["p"]) * onward).alias(c))
    done = rows.select(LINE, "ping", *new)
    others = [c for c in df.columns if c not in (LINE, "ping", *columns)]
    return (df.drop(*columns).join(done, [LINE, "ping"]) if others else done).select(*df.columns)


def projected(df: DataFrame, geo_epsg: int, proj_epsg: int) -> DataFrame:
    """df with x and y in metres."""
    x, y = project(F.col("lat"), F.col("lon"), geo_epsg, proj_epsg)
    return df.withColumns({"x": x, "y": y})


def bearing(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, 0 to 360; null for a stationary pair."""
    angle = F.degrees(F.atan2(dx, dy))
    return F.when((dx == 0) & (dy == 0), None).otherwise(F.when(angle < 0, angle + 360.0).otherwise(angle))


def bearings(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """df with cmg, the bearing to the next row; the last row of a line has none."""
    w = in_chunk()
    return owned(halo(df, 0, 1).withColumn("cmg", bearing(F.lead(x).over(w) - F.col(x), F.lead(y).over(w) - F.col(y))))


def line_lengths(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """line, length: the sum of distances between successive rows."""
    w = in_chunk()
    dx, dy = F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)
    steps = owned(halo(df, 1, 0).withColumn("_d", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0))))
    return steps.groupBy(LINE).agg(F.sum("_d").alias("length"))


def extents(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.groupBy(LINE).agg(F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"), F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"))


def spline_smooth(df: DataFrame, columns: list[str], s: float, with_place: bool, with_curve: str | None = None, whole: int = smoothing.WHOLE, spans: int = SPANS) -> DataFrame:
    """Columns replaced by a parametric cubic smoothing spline of the changing values, spread over all pings.

    With `with_place` the curve is (number of the fix, value), as for a single sequence. The curve parameter
    runs evenly from fix to fix; after the last fix it stays within the curve. Lines with a value that is null or not finite
    stay as they are. A column `with_curve` holds, for each ping, u (its parameter less its fix's), `to` (the next ping's) and c, the
    cubics of the columns from that fix on, four coefficients each.
    """
    folder = workspace(df.sparkSession)
    marked = marked_fixes(df.select(LINE, "ping", *(F.col(c).cast("double").alias(c) for c in columns)), columns)
    counted = running_sum(marked, F.col("is_fix").cast("long"), "_fix").withColumn("_fix", (F.col("_fix") - 1).cast("int"))
    counted = stored(counted, folder, "pings")
    fixes = counted.where("is_fix").select(LINE, F.col("_fix").alias("ping"), F.col("ping").alias("at"), F.array(*columns).alias("point"))
    fixes = stored(smoothing.parameters(fixes, F.col("ping") if with_place else None), folder, "fixes")
    found = smoothing.curves(fixes, s, len(columns) + with_place, whole, spans)
    ready = fixes.join(found, [LINE, "ping"]).select(LINE, F.col("ping").alias("_fix"), "at", "slope", (F.col("n") - 1 - F.col("u")).alias("_left"), "curve")
    spread = counted.join(ready, [LINE, "_fix"], "left")
    u, to = (F.least((F.col("ping") + more - F.col("at")) * F.col("slope"), F.col("_left")) for more in (0, 1))
    cubics = F.slice("curve", 5 if with_place else 1, 4 * len(columns))
    value = lambda i: smoothing.cubic(F.col("_u"), F.col("_c"), i)
    rows = spread.withColumns({"_u": u, "_c": cubics}).select(LINE, "ping", *(F.coalesce(value(i), F.col(c)).alias(c) for i, c in enumerate(columns)), F.struct(F.col("_u").alias("u"), to.alias("to"), F.col("_c").alias("c")).alias("_curve"))
    out = df.drop(*columns).join(rows, [LINE, "ping"])
    return out.select(*df.columns, *([F.col("_curve").alias(with_curve)] if with_curve else []))


def smooth_sequence(df: DataFrame, column: str, s: float) -> DataFrame:
    """Filled, then smoothed as a single sequence."""
    return spline_smooth(fill_zeros(df, column), [column], s, True)


def linear_track(df: DataFrame, s: float = 0.0) -> DataFrame:
    """x, y run linearly between changing fixes; s plays no part."""
    fixes = marked_fixes(df, ["x", "y"], "_fix")
    return interpolate_between_fixes(fixes, ["x", "y"], F.col("_fix")).drop("_fix")


def spline_track(df: DataFrame, s: float = 80.0, with_curve: str | None = None) -> DataFrame:
    return spline_smooth(df, ["x", "y"], s, False, with_curve)


#: By the name that the command line gives.
TRACKS: dict[str, Callable[[DataFrame, float], DataFrame]] = {"linear": linear_track, "bspline": lambda df, s: spline_track(df, s, "curve")}


def prepared_track(df: DataFrame, kind: str, s: float, geo_epsg: int, proj_epsg: int) -> DataFrame:
    """Positions filled, projected and smoothed: df with x and y, and with curve (see spline_smooth) where they follow a spline."""
    if kind not in TRACKS:
        raise ValueError(f"unknown track smoothing {kind}: one of {sorted(TRACKS)}")
    return TRACKS[kind](projected(fill_positions(df), geo_epsg, proj_epsg), s)
