"""The bottom line: first return of the sea bed on both sides of every ping.

Input rows are line, ping (dense from 0), bs. Windows reach a fixed number of pings, so that lines are
dealt out in chunks. Rows of fewer than three samples a side have no bottom and give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seaswath.functions import arrays
from seaswath.operators.ordered import LINE, halo, in_chunk, owned
from seaswath.operators.recurrence import recurrence
from seaswath.sources.tables import stored, workspace

SIDES = ("port", "stbd")
TOTAL = float(arrays.SMOOTH_11[3])


def smoothed_halves(pings: DataFrame) -> DataFrame:
    """df with both halves outward (raw_*) and smoothed ones times the weights' total (smooth_*): whole numbers stay exact."""
    halves = {"raw_port": arrays.port(F.col("bs")), "raw_stbd": arrays.starboard(F.col("bs"))}
    return pings.withColumns(halves).withColumns({f"smooth_{s}": arrays.savgol_numerators(F.col(f"raw_{s}")) for s in SIDES})


def gradients(pings: DataFrame) -> DataFrame:
    """line, ping, h, g_port, g_stbd: the 1-2-1 stencil's step outward at samples 1 to h - 2, times the weights' total.

    Rows before and at the ping are smoothed, the row after it is raw; at a line's ends the missing row is left out.
    """
    w = in_chunk()
    rows = halo(smoothed_halves(pings), 1, 1)
    new = {}
    for s in SIDES:
        new[f"_before_{s}"], new[f"_after_{s}"] = F.lag(f"smooth_{s}").over(w), F.lead(f"raw_{s}").over(w)
    rows = owned(rows.withColumns(new))

    def gradient(s: str) -> Column:
        before, here, after = F.col(f"_before_{s}"), F.col(f"smooth_{s}"), F.col(f"_after_{s}")

        def step(values: Column, j: Column) -> Column:
            return F.get(values, j) - F.get(values, j - 1)

        def total(j: Column) -> Column:
            return 2.0 * step(here, j) + F.coalesce(step(before, j), F.lit(0.0)) + F.coalesce(TOTAL * step(after, j), F.lit(0.0))

        return F.transform(F.sequence(F.lit(1), F.size(here) - 2), total)

    enough = F.size("raw_port") > 2
    return rows.where(enough).select(LINE, "ping", F.size("raw_port").alias("h"), *(gradient(s).alias(f"g_{s}") for s in SIDES))


def thresholds(rows: DataFrame, factor: float, compat: bool = True) -> DataFrame:
    """rows (of gradients) with t_port and t_stbd.

    The first four pings use a share of their own greatest gradient. After that, in the compatible form,
    port uses the starboard side's: the mean of the ping's own share and the four shares stored before it,
    where all from the fourth ping on are stored as the fourth; starboard keeps the fourth. Otherwise each
    side's threshold is the mean of the ping's own share and of that side's thresholds at the four pings before it.
    """
    share = {s: F.array_max(f"g_{s}") * factor for s in SIDES}
    if not compat:
        found = recurrence(rows.select(LINE, "ping", F.array(*share.values()).alias("x")), 0.2, (0.2,) * 4)
        return rows.join(found.select(LINE, "ping", *(F.get("y", F.lit(i)).alias(f"t_{s}") for i, s in enumerate(SIDES))), [LINE, "ping"])
    rows = rows.withColumns({f"_m_{s}": x for s, x in share.items()})
    # Four numbers for each line.
    stored = rows.where("ping < 4").groupBy(LINE).agg(*(F.max(F.when(F.col("ping") == i, F.col("_m_stbd"))).alias(f"_s{i}") for i in range(4)))
    rows = rows.join(stored, LINE)

    def at(i: int) -> Column:  # stored i pings before this one
        place = F.least(F.col("ping") - i, F.lit(3))
        return F.when(place == 0, F.col("_s0")).when(place == 1, F.col("_s1")).when(place == 2, F.col("_s2")).otherwise(F.col("_s3"))

    later = F.col("ping") >= 4
    port = (F.col("_m_stbd") + at(1) + at(2) + at(3) + at(4)) / 5.0
    rows = rows.withColumn("t_port", F.when(later, port).otherwise(F.col("_m_port"))).withColumn("t_stbd", F.when(later, F.col("_s3")).otherwise(F.col("_m_stbd")))
    return rows.drop("_m_port", "_m_stbd", "_s0", "_s1", "_s2", "_s3")


def crossings(gradient: Column, threshold: Column) -> Column:
    """Samples whose gradient reaches the threshold, ascending; the first greatest one if none does."""
    places = F.filter(F.sequence(F.lit(1), F.size(gradient)), lambda j: F.get(gradient, j - 1) >= threshold)
    return F.when(F.size(places) > 0, places).otherwise(F.array(F.array_position(gradient, F.array_max(gradient)).cast("int")))


def nearest_pair(port: Column, stbd: Column) -> Column:
    """struct(d, p, s): the pair of candidates nearest to each other; ties to the smaller port one, then the smaller starboard one."""
    both = F.array_intersect(port, stbd)
    same = F.array_min(both)
    pairs = F.transform(port, lambda p: F.array_min(F.transform(stbd, lambda s: F.struct(F.abs(p - s).alias("d"), p.alias("p"), s.alias("s")))))
    return F.when(F.size(both) > 0, F.struct(F.lit(0).alias("d"), same.alias("p"), same.alias("s"))).otherwise(F.array_min(pairs))


def coarse(pings: DataFrame, factor: float = 0.1, compat: bool = True) -> DataFrame:
    """line, ping, port_x, stbd_x in pixels of the full row (starboard's is one short, as in the published lines)."""
    rows = thresholds(gradients(pings), factor, compat)
    rows = rows.withColumns({f"_c_{s}": crossings(F.col(f"g_{s}"), F.col(f"t_{s}")) for s in SIDES}).withColumn("_pair", nearest_pair(F.col("_c_port"), F.col("_c_stbd")))
    return rows.select(LINE, "ping", (F.col("h") - 1 - F.col("_pair.p")).cast("int").alias("port_x"), (F.col("h") - 1 + F.col("_pair.s")).cast("int").alias("stbd_x"))


def _corrected(x: str, reach: int, rounding: float) -> Column:
    """x, or the weighted mean of its neighbours where it is further from that than their deviation by more than `rounding`.

    The order of additions is kept: by distance, the later neighbour first.
    """
    w = in_chunk()
    total, weight, seen = F.lit(0.0), F.lit(0.0), []
    for j in range(1, reach + 1):
        later, earlier, share = F.lead(x, j).over(w).cast("double"), F.lag(x, j).over(w).cast("double"), 1 - j / reach
        here = F.when(later.isNotNull() & earlier.isNotNull(), F.lit(2 * share)).when(later.isNotNull() | earlier.isNotNull(), F.lit(share)).otherwise(0.0)
        total = total + F.coalesce(later * share, F.lit(0.0)) + F.coalesce(earlier * share, F.lit(0.0))
        weight = weight + here
        seen += [later, earlier]
    near = F.array_compact(F.array(*seen))
    mean = F.aggregate(near, F.lit(0.0), lambda a, b: a + b) / F.size(near)
    spread = F.sqrt(F.aggregate(near, F.lit(0.0), lambda a, b: a + (b - mean) * (b - mean)) / F.size(near))
    expected = F.try_divide(total, weight)
    return F.when(F.abs(F.col(x) - expected) <= spread + rounding, F.col(x)).otherwise(F.coalesce(F.floor(expected).cast("int"), F.col(x)))


def _smoothed(x: str) -> Column:
    """Eleven-ping smoothing of whole numbers: integer numerator, divided at the end; a line's end values repeat."""
    w = in_chunk()
    first, last = F.first(x).over(w), F.last(x).over(w.rowsBetween(0, 10**6))
    total = F.lit(0).cast("long")
    for k, c in arrays.weights(arrays.SMOOTH_11):
        value = F.col(x) if k == 0 else F.coalesce(F.lead(x, k).over(w), last) if k > 0 else F.coalesce(F.lag(x, -k).over(w), first)
        total = total + F.lit(c).cast("long") * value
    return F.floor(total / TOTAL).cast("int")


def _lines_of(bottom: DataFrame, steps: list[str], win_h: int, rounding: float = 0.0) -> DataFrame:
    reach = sum({"correct": win_h, "smooth": 5}[s] for s in steps)
    rows = halo(bottom, reach, reach)
    lengths = bottom.groupBy(LINE).agg((F.max("ping") + 1).alias("_pings")) if "smooth" in steps else None
    for step in steps:
        rows = rows.withColumns({x: _corrected(x, win_h, rounding) if step == "correct" else _smoothed(x) for x in ("port_x", "stbd_x")})
    out = owned(rows)
    if lengths is None:
        return out
    # A line shorter than the smoothing window stays as it is.
    short = bottom.select(LINE, "ping", F.col("port_x").alias("_p"), F.col("stbd_x").alias("_s"))
    kept = out.join(lengths, LINE).join(short.join(lengths.where("_pings < 11").drop("_pings"), LINE, "left_semi"), [LINE, "ping"], "left")
    return kept.withColumns({"port_x": F.coalesce("_p", "port_x"), "stbd_x": F.coalesce("_s", "stbd_x")}).select(*bottom.columns)


def abnormal_corrected(bottom: DataFrame, win_h: int = 10, times: int = 1, rounding: float = 0.0) -> DataFrame:
    """Outliers among win_h pings on each side replaced, `times` over.

    Means of whole numbers are not exact, so that a value as far off as the deviation, or one alike to all its neighbours, can count as an
    outlier. The published lines have it so (rounding 0); a small `rounding` keeps such values.
    """
    return _lines_of(bottom, ["correct"] * times, win_h, rounding)


def smoothed(bottom: DataFrame) -> DataFrame:
    return _lines_of(bottom, ["smooth"], 0)


def detect(pings: DataFrame, factor: float = 0.1, win_h: int = 10, compat: bool = True, rounding: float = 0.0) -> DataFrame:
    """Coarse line, corrected twice, smoothed. Two whole numbers a ping are written in between: later steps read them more than once."""
    folder = workspace(pings.sparkSession)
    found = stored(coarse(pings, factor, compat), folder, "coarse")
    return smoothed(stored(abnormal_corrected(found, win_h, 2, rounding), folder, "corrected"))


def overlay(pings: DataFrame, bottom: DataFrame, radius: int = 1) -> DataFrame:
    """line, ping, bs, marks: the columns of each row that are drawn over by bottom points within `radius` rows and columns."""
    near = bottom.select(LINE, "ping", F.explode(F.array("port_x", "stbd_x")).alias("x")).select(LINE, F.explode(F.sequence(F.col("ping") - radius, F.col("ping") + radius)).alias("ping"), "x")
    drawn = near.select(LINE, "ping", F.explode(F.sequence(F.col("x") - radius, F.col("x") + radius)).alias("x")).groupBy(LINE, "ping").agg(F.array_sort(F.collect_set("x")).alias("marks"))
    return pings.join(drawn, [LINE, "ping"], "left").select(*pings.columns, F.coalesce("marks", F.array().cast("array<int>")).alias("marks"))
