"""Registered queries over the general tables, seen as sonar data, and the SQL that gives the same results.

Each query applies an operator to whole tables. Values from transcendental functions are rounded, since
engines differ in their last bits. Arrays are given as rows of (place, value).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.functions import acoustics, arrays, projection
from seaswath.operators import bottom, gain, geocode, ingest, mosaic, navigation, qc, repair, slant, speed, stretch
from seaswath.plans import tile, views
from seaswath.types import Params

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
RANGE, LAMBD, ALPHA, RES = 80.0, 20.0, 0.2, 1.0
#: What the SQL of corrected bottom lines allows a deviation.
ROUNDING = 1e-9


def query(ctes: str = "", select: str = "") -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL where it is given."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if select:
            SQL[f.__name__] = (f"WITH {ctes.strip()} " if ctes else "") + select
        return f

    return put


def long(df: DataFrame, column: str, place: str = "k", value: str = "v", keys: tuple[str, ...] = ("line", "ping")) -> DataFrame:
    return df.select(*keys, F.posexplode(column).alias(place, value))


def rounded(c: Column | str, digits: int) -> Column:
    return F.round(c, digits)


def and_also(*ctes: str) -> str:
    return ",\n".join(c.strip().rstrip(",") for c in ctes)


# Waterfall: gain, levels, stretches.

TVG = f"""
    tvg AS (SELECT line, ping, k, round(v * CASE WHEN j = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, {LAMBD}::DOUBLE * log10({RANGE}::DOUBLE / 64 * j) + 2.0::DOUBLE * {ALPHA}::DOUBLE * ({RANGE}::DOUBLE / 64 * j)) END, 6) AS v FROM half)"""


def levels_sql(source: str, ratio: float, name: str = "lv") -> str:
    """lo and hi of each line of `source` (line, v)."""
    return f"""
    {name}_e AS (SELECT line, count(*) AS n, max(v) AS top, ceil(max(v)) - 1 AS e FROM {source} GROUP BY line),
    {name}_b AS (SELECT s.line, least(floor(s.v), e - 1) AS bin, count(*) AS c FROM {source} s JOIN {name}_e USING (line) WHERE s.v >= 0 AND s.v <= e GROUP BY ALL),
    {name}_c AS (SELECT line, bin, sum(c) OVER (PARTITION BY line ORDER BY bin) AS s FROM {name}_b),
    {name} AS (SELECT line, any_value(n) AS n, any_value(top) AS top, coalesce(min(bin) FILTER (s > floor(n * {ratio}::DOUBLE)), 0)::DOUBLE AS lo, coalesce(min(bin) FILTER (s > floor(n * (1 - {ratio}::DOUBLE))), 0)::DOUBLE AS hi FROM {name}_e LEFT JOIN {name}_c USING (line) GROUP BY line)"""


STRETCH = "CAST(floor(greatest(1.0::DOUBLE, least(255.0::DOUBLE, CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE 254.0::DOUBLE * (greatest(lo, least(hi, v)) - lo) / (hi - lo) END + 1.0::DOUBLE))) AS INT)"


def gained(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir)
    return rows.withColumn("bs", F.transform(acoustics.tvg(F.col("bs"), RANGE, LAMBD, F.lit(ALPHA)), lambda v: F.round(v, 6)))


@query(
    and_also(views.WATERFALL, TVG, levels_sql("tvg", 0.02), f"g AS (SELECT line, lo, hi, {STRETCH} AS gray FROM tvg JOIN lv USING (line))"),
    "SELECT line, CAST(any_value(lo) AS DOUBLE) AS lo, CAST(any_value(hi) AS DOUBLE) AS hi, count(*) AS samples, CAST(sum(gray) AS BIGINT) AS gray_sum, CAST(max(gray) AS INT) AS gray_max FROM g GROUP BY line",
)
def flagship_tvg_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gained(spark, sf_dir)
    levels = stretch.clip_levels(rows, 0.02).select("line", "lo", "hi")
    gray = rows.join(levels, "line").withColumn("gray", F.transform("bs", lambda v: arrays.linear(v, F.col("lo"), F.col("hi"), 1.0, 255.0)))
    # Sums of each row's array first: no sample is exploded.
    total = F.aggregate("gray", F.lit(0).cast("long"), lambda a, v: a + v)
    return gray.groupBy("line").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.sum(F.size("gray")).alias("samples"), F.sum(total).alias("gray_sum"), F.max(F.array_max("gray").cast("int")).alias("gray_max"))


@query(and_also(views.WATERFALL, TVG), "SELECT line, ping, k, v FROM tvg")
def tvg_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(gained(spark, sf_dir), "bs")


@query(and_also(views.WATERFALL), "SELECT line, ping, side, j, v FROM half")
def port_reverse_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves outward from nadir; together they give the row again."""
    rows = views.waterfall(spark, sf_dir)
    again = rows.withColumn("bs", arrays.joined_halves(arrays.port(F.col("bs")), arrays.starboard(F.col("bs"))))
    sides = again.select("line", "ping", F.explode(F.array(F.struct(F.lit("port").alias("side"), arrays.port(F.col("bs")).alias("h")), F.struct(F.lit("stbd").alias("side"), arrays.starboard(F.col("bs")).alias("h")))).alias("s"))
    return sides.select("line", "ping", F.col("s.side").alias("side"), F.posexplode("s.h").alias("j", "v"))


@query(and_also(views.WATERFALL), "SELECT line, ping, k // 5 AS k, v FROM px WHERE k % 5 = 0 AND k < 60")
def downsample_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir)
    return long(ingest.downsample(rows, 80.0, 13.0), "bs")


def convolved_sql(source: str, kind: tuple[int, int, int, int], size: int) -> str:
    """Sum of integer weights times source.v at j + o, held to 0..size - 1; grouped by all its keys."""
    half, base, slope, _ = kind
    return f"SELECT a.line, a.ping, a.side, a.j, sum(({base} - {slope} * o.o * o.o) * b.v) AS num FROM {source} a CROSS JOIN (SELECT unnest(range(-{half}, {half} + 1)) AS o) o JOIN {source} b ON a.line = b.line AND a.ping = b.ping AND a.side = b.side AND b.j = greatest(0, least({size} - 1, a.j + o.o)) GROUP BY ALL"


SMOOTH = f"sm AS ({convolved_sql('half', arrays.SMOOTH_11, 32)})"


@query(and_also(views.WATERFALL, SMOOTH), "SELECT line, ping, side, j, round(num / 429.0::DOUBLE, 6) AS v FROM sm")
def savgol_samples_11_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bottom.smoothed_halves(views.waterfall(spark, sf_dir))
    sides = rows.select("line", "ping", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"smooth_{s}").alias("h")) for s in bottom.SIDES))).alias("s"))
    return sides.select("line", "ping", F.col("s.side").alias("side"), F.posexplode("s.h").alias("j", "v")).withColumn("v", rounded(F.col("v") / 429.0, 6))


@query(and_also(views.WATERFALL, "whole AS (SELECT line, ping, 'row' AS side, k AS j, v FROM px)", f"sm AS ({convolved_sql('whole', arrays.SMOOTH_51, 64)})"), "SELECT line, ping, j AS k, round(num / 44149.0::DOUBLE, 6) AS v FROM sm")
def savgol_factor_51_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir)
    return long(rows.withColumn("bs", arrays.savgol(F.col("bs"), arrays.SMOOTH_51)), "bs").withColumn("v", rounded("v", 6))


# Bottom line.

GRADIENT = """
    bo AS (SELECT s.*, h.v AS raw FROM sm s JOIN half h USING (line, ping, side, j)),
    d AS (SELECT line, ping, side, j, num - lag(num) OVER w AS ds, 429.0::DOUBLE * (raw - lag(raw) OVER w) AS dr FROM bo WINDOW w AS (PARTITION BY line, ping, side ORDER BY j)),
    g AS (SELECT line, ping, side, j, 2 * ds + coalesce(lag(ds) OVER w, 0) + coalesce(lead(dr) OVER w, 0) AS g FROM d WHERE j BETWEEN 1 AND 30 WINDOW w AS (PARTITION BY line, side, j ORDER BY ping))"""
THRESHOLDS = """
    m AS (SELECT line, ping, 0.1::DOUBLE * max(g) FILTER (side = 'port') AS mp, 0.1::DOUBLE * max(g) FILTER (side = 'stbd') AS ms FROM g GROUP BY line, ping),
    st AS (SELECT line, max(ms) FILTER (ping = 0) AS s0, max(ms) FILTER (ping = 1) AS s1, max(ms) FILTER (ping = 2) AS s2, max(ms) FILTER (ping = 3) AS s3 FROM m GROUP BY line),
    th AS (SELECT line, ping, CASE WHEN ping < 4 THEN mp ELSE (((ms + s3) + CASE WHEN ping - 2 < 3 THEN s2 ELSE s3 END) + CASE WHEN ping - 3 = 1 THEN s1 WHEN ping - 3 = 2 THEN s2 ELSE s3 END + CASE WHEN ping = 4 THEN s0 WHEN ping = 5 THEN s1 WHEN ping = 6 THEN s2 ELSE s3 END) / 5.0::DOUBLE END AS t_port, CASE WHEN ping < 4 THEN ms ELSE s3 END AS t_stbd FROM m JOIN st USING (line))"""


@query(and_also(views.WATERFALL, SMOOTH, GRADIENT), "SELECT line, ping, side, j, CAST(g AS DOUBLE) AS g FROM g")
def gradient_stencil(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bottom.gradients(views.waterfall(spark, sf_dir))
    sides = rows.select("line", "ping", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"g_{s}").alias("h")) for s in bottom.SIDES))).alias("s"))
    return sides.select("line", "ping", F.col("s.side").alias("side"), F.posexplode("s.h").alias("j", "g")).withColumn("j", F.col("j") + 1)


@query(and_also(views.WATERFALL, SMOOTH, GRADIENT, THRESHOLDS), "SELECT line, ping, round(t_port, 4) AS t_port, round(t_stbd, 4) AS t_stbd FROM th")
def gradient_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bottom.thresholds(bottom.gradients(views.waterfall(spark, sf_dir)), 0.1)
    return rows.select("line", "ping", rounded("t_port", 4).alias("t_port"), rounded("t_stbd", 4).alias("t_stbd"))


#: Each side's own thresholds, ping after ping (a recursive table, so WITH RECURSIVE).
RECURRENCE = """
    m AS (SELECT line, ping, 0.1::DOUBLE * max(g) FILTER (side = 'port') AS mp, 0.1::DOUBLE * max(g) FILTER (side = 'stbd') AS ms FROM g GROUP BY line, ping),
    rc AS (SELECT line, ping, [mp] AS p, [ms] AS s FROM m WHERE ping = 0
        UNION ALL
        SELECT m.line, m.ping, list_prepend(CASE WHEN m.ping < 4 THEN mp ELSE (mp + list_sum(p[:4])) / 5.0::DOUBLE END, p[:3]), list_prepend(CASE WHEN m.ping < 4 THEN ms ELSE (ms + list_sum(s[:4])) / 5.0::DOUBLE END, s[:3])
        FROM rc JOIN m ON m.line = rc.line AND m.ping = rc.ping + 1),
    th AS (SELECT line, ping, p[1] AS t_port, s[1] AS t_stbd FROM rc)"""


@query("RECURSIVE " + and_also(views.WATERFALL, SMOOTH, GRADIENT, RECURRENCE), "SELECT line, ping, round(t_port, 4) AS t_port, round(t_stbd, 4) AS t_stbd FROM th")
def gradient_threshold_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thresholds as they are meant: a linear recurrence of each side's own ones."""
    rows = bottom.thresholds(bottom.gradients(views.waterfall(spark, sf_dir)), 0.1, compat=False)
    return rows.select("line", "ping", rounded("t_port", 4).alias("t_port"), rounded("t_stbd", 4).alias("t_stbd"))


COARSE = """
    hit AS (SELECT line, ping, side, j FROM g JOIN th USING (line, ping) WHERE g >= CASE WHEN side = 'port' THEN t_port ELSE t_stbd END),
    best AS (SELECT line, ping, side, min(j) AS j FROM (SELECT *, rank() OVER (PARTITION BY line, ping, side ORDER BY g DESC) AS r FROM g) WHERE r = 1 GROUP BY line, ping, side),
    cand AS (SELECT * FROM hit UNION ALL SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.line = b.line AND h.ping = b.ping AND h.side = b.side)),
    pair AS (SELECT p.line, p.ping, p.j AS p, s.j AS s, row_number() OVER (PARTITION BY p.line, p.ping ORDER BY abs(p.j - s.j), p.j, s.j) AS r FROM cand p JOIN cand s ON p.line = s.line AND p.ping = s.ping AND p.side = 'port' AND s.side = 'stbd')"""


@query(and_also(views.WATERFALL, SMOOTH, GRADIENT, THRESHOLDS, COARSE), "SELECT line, ping, CAST(31 - p AS INT) AS port_x, CAST(31 + s AS INT) AS stbd_x FROM pair WHERE r = 1")
def bottom_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom.coarse(views.waterfall(spark, sf_dir))


@query("RECURSIVE " + and_also(views.WATERFALL, SMOOTH, GRADIENT, RECURRENCE, COARSE), "SELECT line, ping, CAST(31 - p AS INT) AS port_x, CAST(31 + s AS INT) AS stbd_x FROM pair WHERE r = 1")
def bottom_coarse_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom.coarse(views.waterfall(spark, sf_dir), compat=False)


BOTTOM = "bt AS (SELECT line, ping, CAST(max(v) FILTER (k = 0) AS INT) % 31 AS port_x, 32 + CAST(max(v) FILTER (k = 1) AS INT) % 31 AS stbd_x FROM px GROUP BY line, ping)"


def bottom_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir)
    return rows.select("line", "ping", (F.col("bs")[0].cast("int") % 31).alias("port_x"), (32 + F.col("bs")[1].cast("int") % 31).alias("stbd_x"))


def _abnormal_sql(x: str) -> str:
    total, weight, seen = "0.0::DOUBLE", "0.0::DOUBLE", []
    for j in range(1, 11):
        later, earlier, w = f"lead({x}, {j}) OVER w", f"lag({x}, {j}) OVER w", f"{1 - j / 10}::DOUBLE"
        total = f"(({total} + coalesce({later} * {w}, 0)) + coalesce({earlier} * {w}, 0))"
        weight = f"({weight} + CASE WHEN {later} IS NOT NULL AND {earlier} IS NOT NULL THEN 2 * {w} WHEN {later} IS NOT NULL OR {earlier} IS NOT NULL THEN {w} ELSE 0 END)"
        seen += [later, earlier]
    return f"{total} / nullif({weight}, 0) AS m_{x}, [{', '.join(seen)}] AS near_{x}"


def abnormal(source: str, result: str) -> str:
    """Tables that correct a bottom line once."""
    return f"""
    n_{result} AS (SELECT line, ping, port_x, stbd_x, {_abnormal_sql('port_x')}, {_abnormal_sql('stbd_x')} FROM {source} WINDOW w AS (PARTITION BY line ORDER BY ping)),
    {result} AS (SELECT line, ping, CASE WHEN abs(port_x - m_port_x) <= list_stddev_pop(near_port_x) + 1e-9 THEN port_x ELSE CAST(floor(m_port_x) AS INT) END AS port_x, CASE WHEN abs(stbd_x - m_stbd_x) <= list_stddev_pop(near_stbd_x) + 1e-9 THEN stbd_x ELSE CAST(floor(m_stbd_x) AS INT) END AS stbd_x FROM n_{result})"""


@query(and_also(views.WATERFALL, BOTTOM, abnormal("bt", "ab")), "SELECT line, ping, port_x, stbd_x FROM ab")
def bottom_abnormal_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom.abnormal_corrected(bottom_view(spark, sf_dir), rounding=ROUNDING)


def _smooth_sql(x: str) -> str:
    terms = [f"{c} * coalesce({f'lead({x}, {k}) OVER w' if k > 0 else f'lag({x}, {-k}) OVER w' if k else x}, {'last_value' if k > 0 else 'first_value'}({x}) OVER (PARTITION BY line ORDER BY ping ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))" for k, c in arrays.weights(arrays.SMOOTH_11)]
    return f"CAST(floor(({' + '.join(terms)}) / 429.0::DOUBLE) AS INT) AS {x}"


@query(and_also(views.WATERFALL, BOTTOM), f"SELECT line, ping, {_smooth_sql('port_x')}, {_smooth_sql('stbd_x')} FROM bt WINDOW w AS (PARTITION BY line ORDER BY ping)")
def bottom_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom.smoothed(bottom_view(spark, sf_dir))


DETECTED = "bt AS (SELECT line, ping, CAST(31 - p AS INT) AS port_x, CAST(31 + s AS INT) AS stbd_x FROM pair WHERE r = 1)"


@query(
    and_also(views.WATERFALL, SMOOTH, GRADIENT, THRESHOLDS, COARSE, DETECTED, abnormal("bt", "once"), abnormal("once", "twice")),
    f"SELECT line, ping, {_smooth_sql('port_x')}, {_smooth_sql('stbd_x')} FROM twice WINDOW w AS (PARTITION BY line ORDER BY ping)",
)
def bottom_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom.detect(views.waterfall(spark, sf_dir), rounding=ROUNDING)


@query()
def bottom_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.peaks(bottom_view(spark, sf_dir), 64)


@query()
def bottom_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(bottom_view(spark, sf_dir), 64)


MARKS = "near AS (SELECT DISTINCT b.line, b.ping + y.d AS ping, x + e.d AS k FROM (SELECT line, ping, unnest([port_x, stbd_x]) AS x FROM bt) b CROSS JOIN (SELECT unnest([-1, 0, 1]) AS d) y CROSS JOIN (SELECT unnest([-1, 0, 1]) AS d) e)"


@query(and_also(views.WATERFALL, BOTTOM, MARKS), "SELECT line, ping, CAST(k AS INT) AS k FROM near JOIN (SELECT DISTINCT line, ping FROM px) p USING (line, ping)")
def bottom_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = bottom.overlay(views.waterfall(spark, sf_dir), bottom_view(spark, sf_dir))
    return drawn.select("line", "ping", F.explode("marks").alias("k"))


# Gray levels.


@query(and_also(views.WATERFALL, levels_sql("px", 0.02)), "SELECT line, CAST(bin AS BIGINT) AS bin, CAST(c AS BIGINT) AS count FROM lv_b")
def histogram_unit_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stretch.histogram(views.waterfall(spark, sf_dir)).select("line", "bin", "count")


@query(and_also(views.WATERFALL, levels_sql("px", 0.02)), f"SELECT line, ping, k, {STRETCH} AS gray FROM px JOIN lv USING (line)")
def linear_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(stretch.linear_stretch(views.waterfall(spark, sf_dir)), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


@query(
    and_also(views.WATERFALL, levels_sql("px", 0.02)),
    "SELECT line, ping, k, CAST(CASE WHEN v <= 1 THEN 1 ELSE floor(CASE WHEN v > hi THEN coalesce(155.0::DOUBLE / nullif(top - hi, 0), 0) * (v - hi) + 100.0::DOUBLE ELSE coalesce(99.0::DOUBLE / nullif(hi - 1.0::DOUBLE, 0), 0) * (v - 1.0::DOUBLE) + 1.0::DOUBLE END) END AS INT) AS gray FROM px JOIN lv USING (line)",
)
def piecewise_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(stretch.piecewise_stretch(views.waterfall(spark, sf_dir)), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


HELD = "held AS (SELECT *, greatest(1.0::DOUBLE, least(256.0::DOUBLE, v)) AS w, greatest(1.0::DOUBLE, least(256.0::DOUBLE, max(v) OVER (PARTITION BY line))) AS m FROM px)"


@query(and_also(views.WATERFALL, HELD), "SELECT line, ping, k, CAST(floor(greatest(0.0::DOUBLE, least(255.0::DOUBLE, 256.0::DOUBLE * ln(1.0::DOUBLE + 200.0::DOUBLE * w / m) / ln(201.0::DOUBLE)))) AS INT) AS gray FROM held")
def log_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(stretch.log_transform(views.waterfall(spark, sf_dir)), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


@query(and_also(views.WATERFALL, HELD), "SELECT line, ping, k, CAST(floor(greatest(0.0::DOUBLE, least(255.0::DOUBLE, 256.0::DOUBLE * pow(w / m, 0.5::DOUBLE)))) AS INT) AS gray FROM held")
def gamma_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(stretch.gamma_transform(views.waterfall(spark, sf_dir)), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


@query(
    and_also(views.WATERFALL, "ten AS (SELECT line, ping, k, v * 10.0::DOUBLE AS v FROM px)", levels_sql("ten", 0.01)),
    "SELECT line, ping, k, CAST(floor(greatest(0.0::DOUBLE, least(255.0::DOUBLE, hi * ln(1.0::DOUBLE + 200.0::DOUBLE * greatest(lo, least(hi, v)) / greatest(lo, least(hi, top))) / ln(201.0::DOUBLE)))) AS INT) AS gray FROM ten JOIN lv USING (line)",
)
def log_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(stretch.log_gain(views.waterfall(spark, sf_dir)), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


@query(and_also(views.WATERFALL), "SELECT line, ping, k, CAST(round_even(greatest(0.0::DOUBLE, least(255.0::DOUBLE, v / 4.0::DOUBLE)), 0) AS INT) AS gray FROM px")
def clip_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir).withColumn("bs", F.transform("bs", lambda v: v / 4.0))
    return long(stretch.byte_image(rows), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


# Slant range and gain.

SLANT = f"""
    {BOTTOM},
    xb AS (SELECT line, ping, 32 - port_x + 2 AS p, stbd_x - 32 + 5 AS s FROM bt),
    wd AS (SELECT line, CAST(greatest(floor(sqrt(greatest(0, 1024 - power(min(p), 2)))), floor(sqrt(greatest(0, 1024 - power(min(s), 2))))) AS INT) AS width, CAST(floor(sqrt(greatest(0, 1024 - power(max(p), 2)))) AS INT) AS min_port_width, CAST(floor(sqrt(greatest(0, 1024 - power(max(s), 2)))) AS INT) AS min_stbd_width FROM xb GROUP BY line)"""


@query(and_also(views.WATERFALL, SLANT), "SELECT * FROM wd")
def slant_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slant.widths(slant.with_depths(views.waterfall(spark, sf_dir), bottom_view(spark, sf_dir), (2, 5)))


FLAT = """
    fl AS (SELECT line, ping, side, CAST(x AS INT) AS x, CAST(floor(sqrt(power(CASE WHEN side = 'port' THEN p ELSE s END, 2) + x * x)) AS INT) AS src, width FROM xb JOIN wd USING (line) CROSS JOIN range(0, 32) r(x) CROSS JOIN (VALUES ('port'), ('stbd')) q(side) WHERE x < width),
    flat AS (SELECT fl.line, fl.ping, CASE WHEN fl.side = 'port' THEN width - 1 - x ELSE width + x END AS k, coalesce(h.v, 0.0::DOUBLE) AS v FROM fl LEFT JOIN half h ON h.line = fl.line AND h.ping = fl.ping AND h.side = fl.side AND h.j = fl.src)"""


def flat_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slant.correct(views.waterfall(spark, sf_dir), bottom_view(spark, sf_dir), (2, 5))


@query(and_also(views.WATERFALL, SLANT, FLAT), "SELECT line, ping, CAST(k AS INT) AS k, v FROM flat")
def slant_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(flat_view(spark, sf_dir), "bs")


def with_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The waterfall with least ground widths of 28 and 30 samples."""
    return views.waterfall(spark, sf_dir).withColumns({"min_port_width": F.lit(28), "min_stbd_width": F.lit(30)})


def factor_sql(source: str = "half", to: str = "") -> str:
    """Smoothed factors `fs` of each line of `source` (line, ping, side, j, v); all names begin with `to`."""
    return f"""
    {to}cm AS (SELECT line, side, j, avg(v) AS m FROM {source} GROUP BY ALL),
    {to}sd AS (SELECT line, side, avg(v) AS m FROM {source} GROUP BY ALL),
    {to}fa AS (SELECT c.line, 0 AS ping, 'row' AS side, CAST(CASE WHEN c.side = 'port' THEN 31 - c.j ELSE 32 + c.j END AS INT) AS j, coalesce(s.m / nullif(e.m, 0), 0) AS v FROM {to}cm c JOIN {to}sd s USING (line, side) JOIN {to}cm e ON e.line = c.line AND e.side = c.side AND e.j = least(c.j, 27)),
    {to}fs AS (SELECT line, j AS k, round(num / 44149.0::DOUBLE, 9) AS f FROM ({convolved_sql(f"{to}fa", arrays.SMOOTH_51, 64)}))"""


FACTOR = factor_sql()


def nine_digits(found: DataFrame) -> DataFrame:
    return found.withColumn("factor", F.transform("factor", lambda f: F.round(f, 9)))


@query(and_also(views.WATERFALL, FACTOR), "SELECT line, k, round(f, 6) AS f FROM fs")
def gain_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(nine_digits(gain.factors(with_widths(spark, sf_dir))), "factor", value="f", keys=("line",)).withColumn("f", rounded("f", 6))


@query(and_also(views.WATERFALL, FACTOR, "en AS (SELECT line, ping, k, v * f AS v FROM px JOIN fs USING (line, k))", levels_sql("en", 0.02)), f"SELECT line, ping, k, {STRETCH} AS gray FROM en JOIN lv USING (line)")
def statistic_enhance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_widths(spark, sf_dir)
    done = stretch.linear_stretch(gain.applied(rows, nine_digits(gain.factors(rows))), 0.02)
    return long(done, "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


@query()
def statistic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gain.statistic_fit(with_widths(spark, sf_dir)).select("line", "ping", "gray")


#: Share of the highest peak that a quiet ping's mean is above: about half of these tables' pings are, at the usual 0.3 all of them.
QUIET_SHARE = 0.58

#: Pings whose smoothed, levelled samples have no prominent peak, or a mean above that share of the highest one.
QUIET = f"""
    co AS (SELECT line, ping, 'row' AS side, k AS j, v * f * 10.0::DOUBLE AS v FROM px JOIN fs USING (line, k)),
    cs AS (SELECT line, ping, j, num / 429.0::DOUBLE AS x FROM ({convolved_sql("co", arrays.SMOOTH_11, 64)})),
    ng AS (SELECT *, lag(x) OVER (PARTITION BY line, ping ORDER BY j) AS before, lead(x) OVER (PARTITION BY line, ping ORDER BY j) AS after, min(x) OVER (PARTITION BY line, ping) AS low, avg(x) OVER (PARTITION BY line, ping) AS mean FROM cs),
    pk AS (SELECT line, ping, j, x, mean FROM ng WHERE x > before AND x > after AND x >= low + {gain.PROMINENCE}),
    pn AS (SELECT p.line, p.ping, p.j, p.x, p.mean, coalesce(max(o.j) FILTER (o.j < p.j AND o.x > p.x), -1) AS a, coalesce(min(o.j) FILTER (o.j > p.j AND o.x > p.x), 64) AS b FROM pk p JOIN cs o USING (line, ping) GROUP BY ALL),
    pm AS (SELECT p.line, p.ping, p.x, p.mean, p.x - greatest(min(o.x) FILTER (o.j > a AND o.j <= p.j), min(o.x) FILTER (o.j >= p.j AND o.j < b)) AS above FROM pn p JOIN cs o USING (line, ping) GROUP BY p.line, p.ping, p.j, p.x, p.mean, p.a, p.b),
    ob AS (SELECT line, ping FROM pm WHERE above >= {gain.PROMINENCE} GROUP BY line, ping HAVING min(mean) / max(x) <= {QUIET_SHARE}::DOUBLE),
    qp AS (SELECT DISTINCT line, ping FROM px WHERE (line, ping) NOT IN (SELECT (line, ping) FROM ob))"""


@query(and_also(views.WATERFALL, FACTOR, QUIET), "SELECT line, ping FROM qp")
def no_object_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_widths(spark, sf_dir)
    return gain.no_object_pings(rows, QUIET_SHARE, coarse=nine_digits(gain.factors(rows))).select("line", "ping")


FINE = and_also(
    "qh AS (SELECT half.* FROM half JOIN qp USING (line, ping))",
    factor_sql("qh", "q"),
    "ef AS (SELECT line, ping, k, v * coalesce(qfs.f, fs.f) AS v FROM px JOIN fs USING (line, k) LEFT JOIN qfs USING (line, k))",
    levels_sql("ef", 0.02),
)


@query(and_also(views.WATERFALL, FACTOR, QUIET, FINE), f"SELECT line, ping, k, {STRETCH} AS gray FROM ef JOIN lv USING (line)")
def coarse2fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(gain.coarse2fine(with_widths(spark, sf_dir), prob_thred=QUIET_SHARE), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


def mirrored_sql(at: str, n: str) -> str:
    """A place mirrored at the first and last of n, which do not repeat."""
    period = f"greatest(1, 2 * ({n} - 1))"
    inside = f"((({at}) % {period} + {period}) % {period})"
    return f"least({inside}, {period} - {inside})"


RETINEX = f"""
    wt AS (SELECT d, exp(-d * d / 18.0::DOUBLE) / sum(exp(-d * d / 18.0::DOUBLE)) OVER () AS w FROM (SELECT unnest(range(-12, 13)) AS d)),
    hz AS (SELECT a.line, a.ping, a.k, sum(b.v * w) AS v FROM (SELECT line, ping, k, w, {mirrored_sql("k + d", "64")} AS at FROM px, wt) a JOIN px b ON b.line = a.line AND b.ping = a.ping AND b.k = a.at GROUP BY ALL),
    pn AS (SELECT line, max(ping) + 1 AS n FROM px GROUP BY line),
    bl AS (SELECT a.line, a.ping, a.k, sum(b.v * w) AS blur FROM (SELECT line, ping, k, w, {mirrored_sql("ping + d", "n")} AS at FROM px JOIN pn USING (line), wt) a JOIN hz b ON b.line = a.line AND b.ping = a.at AND b.k = a.k GROUP BY ALL)"""


@query(and_also(views.WATERFALL, RETINEX), "SELECT line, ping, k, CAST(floor(greatest(0, least(255, v * 10.0::DOUBLE / (blur + 0.05::DOUBLE)))) AS INT) AS gray FROM px JOIN bl USING (line, ping, k)")
def retinex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(gain.retinex(views.waterfall(spark, sf_dir), 3.0), "gray", value="gray").withColumn("gray", F.col("gray").cast("int"))


# Messages and pings.

PROJECTED = "SELECT seq, round_even(x / 10000.0::DOUBLE / 60.0::DOUBLE, 6) AS lon, round_even(y / 10000.0::DOUBLE / 60.0::DOUBLE, 6) AS lat, round_even(heading / 100.0::DOUBLE, 4) AS heading, round_even(pitch / 32768.0::DOUBLE * 180.0::DOUBLE, 4) AS pitch, round_even(roll / 32768.0::DOUBLE * 180.0::DOUBLE, 4) AS roll, speed / 10.0::DOUBLE AS speed, CAST(course AS DOUBLE) AS course FROM msg WHERE messagetype = 80 AND subsystem = 20"


@query(and_also(views.MESSAGES), PROJECTED)
def message_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.acoustic(views.messages(spark, sf_dir), 20).select("seq", *ingest.navigation())


PAIRS = """
    ac AS (SELECT * FROM msg WHERE messagetype = 80 AND subsystem = 20),
    sides AS (SELECT ping_number, max(seq) FILTER (channel = 0) AS port_seq, max(seq) FILTER (channel <> 0) AS stbd_seq FROM ac GROUP BY ping_number)"""


@query(and_also(views.MESSAGES, PAIRS), "SELECT ping_number, port_seq, stbd_seq, CAST(row_number() OVER (ORDER BY ping_number) - 1 AS INT) AS ping FROM sides WHERE port_seq IS NOT NULL AND stbd_seq IS NOT NULL")
def ping_pairing_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = ingest.paired(ingest.acoustic(views.messages(spark, sf_dir), 20)).select("line", "ping_number", F.col("port.seq").alias("port_seq"), F.col("starboard.seq").alias("stbd_seq"))
    return ingest.numbered(both, ["line"], ["ping_number"], F.floor(F.col("ping_number") / ingest.BUCKET)).drop("line")


@query(and_also(views.MESSAGES, PAIRS), "SELECT ping_number, CASE WHEN port_seq IS NULL THEN 'port' ELSE 'starboard' END AS missing FROM sides WHERE port_seq IS NULL OR stbd_seq IS NULL")
def ping_pairing_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.pairing_errors(ingest.acoustic(views.messages(spark, sf_dir), 20)).drop("line")


@query(and_also(views.MESSAGES, PAIRS), "SELECT seq FROM ac WHERE seq NOT IN (SELECT unnest([port_seq, stbd_seq]) FROM sides WHERE port_seq IS NOT NULL AND stbd_seq IS NOT NULL)")
def leftover_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.leftovers(ingest.acoustic(views.messages(spark, sf_dir), 20)).select("seq")


# Navigation.


@query(and_also(views.NAVIGATION), "SELECT line, ping, lon, lat FROM (SELECT *, lag(lon) OVER w AS a, lag(lat) OVER w AS b FROM nav WINDOW w AS (PARTITION BY line ORDER BY ping)) WHERE ping = 0 OR lon <> a OR lat <> b")
def adjacent_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.without_repeats(views.navigation(spark, sf_dir).select("line", "ping", "lon", "lat"), ["lon", "lat"])


def _filled_sql(column: str, missing: str) -> str:
    value = f"CASE WHEN NOT ({missing}) THEN {column} END"
    return f"coalesce(last_value({value} IGNORE NULLS) OVER (PARTITION BY line ORDER BY ping ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({value} IGNORE NULLS) OVER (PARTITION BY line ORDER BY ping ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {column}"


FILLED = f"fp AS (SELECT line, ping, {_filled_sql('lon', 'lon = 0 AND lat = 0')}, {_filled_sql('lat', 'lon = 0 AND lat = 0')} FROM nav)"


@query(and_also(views.NAVIGATION), f"SELECT line, ping, {_filled_sql('speed', 'speed = 0')} FROM nav")
def fill_scalar_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.fill_zeros(views.navigation(spark, sf_dir).select("line", "ping", "speed"), "speed")


@query(and_also(views.NAVIGATION, FILLED), "SELECT line, ping, lon, lat FROM fp")
def fill_position_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_view(spark, sf_dir)


def filled_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.fill_positions(views.navigation(spark, sf_dir).select("line", "ping", "lon", "lat"))


INTERPOLATED = """
    fx AS (SELECT *, ping = 0 OR lon <> lag(lon) OVER w OR lat <> lag(lat) OVER w AS fix FROM fp WINDOW w AS (PARTITION BY line ORDER BY ping)),
    kept AS (SELECT line, ping AS p, lon AS vlon, lat AS vlat, lead(ping) OVER w AS np, lead(lon) OVER w AS nlon, lead(lat) OVER w AS nlat, lag(ping) OVER w AS bp, lag(lon) OVER w AS blon, lag(lat) OVER w AS blat FROM fx WHERE fix WINDOW w AS (PARTITION BY line ORDER BY ping)),
    it AS (SELECT f.line, f.ping, vlon + (f.ping - p) * CASE WHEN np IS NOT NULL THEN (nlon - vlon) / (np - p) WHEN bp IS NOT NULL THEN (vlon - blon) / (p - bp) ELSE 0 END AS lon, vlat + (f.ping - p) * CASE WHEN np IS NOT NULL THEN (nlat - vlat) / (np - p) WHEN bp IS NOT NULL THEN (vlat - blat) / (p - bp) ELSE 0 END AS lat FROM fx f ASOF JOIN kept k ON f.line = k.line AND f.ping >= k.p)"""


@query(and_also(views.NAVIGATION, FILLED, INTERPOLATED), "SELECT line, ping, round(lon, 8) AS lon, round(lat, 8) AS lat FROM it")
def interpolate_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = navigation.marked_fixes(filled_view(spark, sf_dir).select("line", "ping", "lon", "lat"), ["lon", "lat"], "is_fix")
    done = navigation.interpolate_between_fixes(marked, ["lon", "lat"], F.col("is_fix"))
    return done.select("line", "ping", rounded("lon", 8).alias("lon"), rounded("lat", 8).alias("lat"))


def _project_sql(source: str) -> str:
    """x, y of source (line, ping, lon, lat), by the same series written out."""
    radius, e, forward, _ = projection._series(4490)
    zone = projection.zone_of(4499)
    x, y = "east", "north"
    for j, c in enumerate(forward, 1):
        x += f" + {c!r}::DOUBLE * cos({2 * j} * north) * sinh({2 * j} * east)"
        y += f" + {c!r}::DOUBLE * sin({2 * j} * north) * cosh({2 * j} * east)"
    return f"""
    pj1 AS (SELECT line, ping, lon, lat, radians(lon - {zone.meridian}::DOUBLE) AS turn, sinh(atanh(sin(radians(lat))) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(radians(lat)))) AS t FROM {source}),
    pj2 AS (SELECT line, ping, lon, lat, atan2(t, cos(turn)) AS north, atanh(sin(turn) / sqrt(1 + t * t)) AS east FROM pj1),
    pj AS (SELECT line, ping, lon, lat, {zone.false_easting}::DOUBLE + {radius!r}::DOUBLE * ({x}) AS x, {radius!r}::DOUBLE * ({y}) AS y FROM pj2)"""


@query(and_also(views.NAVIGATION, FILLED, _project_sql("fp")), "SELECT line, ping, round(x, 3) AS x, round(y, 3) AS y FROM pj")
def project_gk(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = navigation.projected(filled_view(spark, sf_dir), 4490, 4499)
    return done.select("line", "ping", rounded("x", 3).alias("x"), rounded("y", 3).alias("y"))


@query(and_also(views.NAVIGATION, FILLED), "SELECT line, ping, round(lat, 7) AS lat, round(lon, 7) AS lon FROM fp")
def unproject_gk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back: positions again."""
    done = navigation.projected(filled_view(spark, sf_dir), 4490, 4499)
    lat, lon = projection.unproject(F.col("x"), F.col("y"), 4490, 4499)
    return done.select("line", "ping", rounded(lat, 7).alias("lat"), rounded(lon, 7).alias("lon"))


#: A plane track in whole centimetres: every quantity that follows is far from a rounding edge.
PLANE = "tr AS (SELECT line, ping, (lon - 119.0::DOUBLE) * 1e5::DOUBLE * 0.37::DOUBLE AS x, (lat - 37.0::DOUBLE) * 1e5::DOUBLE * 0.23::DOUBLE AS y FROM fp)"


def plane_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_view(spark, sf_dir).select("line", "ping", ((F.col("lon") - 119.0) * 1e5 * 0.37).alias("x"), ((F.col("lat") - 37.0) * 1e5 * 0.23).alias("y"))


@query(
    and_also(views.NAVIGATION, FILLED, PLANE, "st AS (SELECT line, ping, lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy FROM tr WINDOW w AS (PARTITION BY line ORDER BY ping))"),
    "SELECT line, ping, CASE WHEN dx IS NULL OR (dx = 0 AND dy = 0) THEN NULL ELSE round(CASE WHEN degrees(atan2(dx, dy)) < 0 THEN degrees(atan2(dx, dy)) + 360 ELSE degrees(atan2(dx, dy)) END, 4) END AS cmg FROM st",
)
def cog_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.bearings(plane_view(spark, sf_dir)).select("line", "ping", rounded("cmg", 4).alias("cmg"))


@query(
    and_also(views.NAVIGATION, FILLED, PLANE, "st AS (SELECT line, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM tr WINDOW w AS (PARTITION BY line ORDER BY ping))"),
    "SELECT line, round(sum(coalesce(sqrt(dx * dx + dy * dy), 0)), 4) AS length FROM st GROUP BY line",
)
def survey_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.line_lengths(plane_view(spark, sf_dir)).withColumn("length", rounded("length", 4))


@query(and_also(views.NAVIGATION), "SELECT line, min(lon) AS min_lon, max(lon) AS max_lon, min(lat) AS min_lat, max(lat) AS max_lat FROM nav GROUP BY line")
def geo_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.extents(views.navigation(spark, sf_dir))


@query()
def spline_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.spline_track(plane_view(spark, sf_dir), 80.0)


@query()
def smooth_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.smooth_sequence(views.navigation(spark, sf_dir).select("line", "ping", "speed"), "speed", 1e5)


# Absorption.

GRID = "gr AS (SELECT p_partkey, 2.0::DOUBLE + p_size % 30 AS t, 20.0::DOUBLE + p_partkey % 16 AS s, 1.0::DOUBLE + p_partkey % 50 AS d, 7.7::DOUBLE + p_size % 7 * 0.1::DOUBLE AS ph FROM part)"


def absorption_of(spark: SparkSession, sf_dir: str, formula: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey")
    found = acoustics.absorption(6e5, 2.0 + size % 30, 20.0 + key % 16, 1.0 + key % 50, 7.7 + size % 7 * 0.1, formula)
    return p.select("p_partkey", rounded(found, 9).alias("db"))


@query(
    GRID,
    "SELECT p_partkey, round((0.106::DOUBLE * (f1 * 360000 / (f1 * f1 + 360000)) * exp((ph - 8) / 0.56::DOUBLE) + 0.52::DOUBLE * (1 + t / 43) * (s / 35) * (f2 * 360000 / (f2 * f2 + 360000)) * exp(-d / 6000) + 0.00049::DOUBLE * 360000 * exp(-(t / 27 + d / 1000))) / 1000, 9) AS db FROM (SELECT *, 0.78::DOUBLE * sqrt(s / 35) * exp(t / 26) AS f1, 42 * exp(t / 17) AS f2 FROM gr)",
)
def absorption_am(spark: SparkSession, sf_dir: str) -> DataFrame:
    return absorption_of(spark, sf_dir, "AM")


@query(
    GRID,
    "SELECT p_partkey, round((8.86::DOUBLE / c * pow(10, 0.78::DOUBLE * ph - 5) * f1 * 360000 / (360000 + f1 * f1) + 21.44::DOUBLE * s / c * (1 + 0.025::DOUBLE * t) * (1 - 1.37e-4::DOUBLE * d + 6.2e-9::DOUBLE * d * d) * f2 * 360000 / (360000 + f2 * f2) + a3 * (1 - 3.83e-5::DOUBLE * d + 4.9e-10::DOUBLE * d * d) * 360000) / 1000, 9) AS db FROM (SELECT *, 1412 + 3.21::DOUBLE * t + 1.19::DOUBLE * s + 0.0167::DOUBLE * d AS c, 2.8::DOUBLE * sqrt(s / 35) * pow(10, 4 - 1245 / (t + 273)) AS f1, 8.17::DOUBLE * pow(10, 8 - 1990 / (t + 273)) / (1 + 0.0018::DOUBLE * (s - 35)) AS f2, CASE WHEN t < 20 THEN 4.937e-4::DOUBLE - 2.59e-5::DOUBLE * t + 9.11e-7::DOUBLE * t * t - 1.5e-8::DOUBLE * t * t * t ELSE 3.964e-4::DOUBLE - 1.146e-5::DOUBLE * t + 1.45e-7::DOUBLE * t * t - 6.5e-10::DOUBLE * t * t * t END AS a3 FROM gr)",
)
def absorption_fg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return absorption_of(spark, sf_dir, "FG")


@query(
    GRID,
    "SELECT p_partkey, round(a * f1 * 3.6e11::DOUBLE / (f1 * f1 + 3.6e11::DOUBLE) + b * f2 * 3.6e11::DOUBLE / (f2 * f2 + 3.6e11::DOUBLE) + c * 3.6e11::DOUBLE, 9) AS db FROM (SELECT *, 1320 * (t + 273) * exp(-1700 / (t + 273)) AS f1, 1.55e7::DOUBLE * (t + 273) * exp(-3052 / (t + 273)) AS f2, 8.95e-8::DOUBLE * (1 + t * (2.29e-2::DOUBLE - 5.08e-4::DOUBLE * t)) AS a, s / 35 * 4.88e-7::DOUBLE * (1 + 0.0134::DOUBLE * t) * (1 - 0.00103::DOUBLE * k + 3.7e-7::DOUBLE * k * k) AS b, 4.86e-13::DOUBLE * (1 + t * (-0.042::DOUBLE + t * (8.53e-4::DOUBLE - t * 6.23e-6::DOUBLE))) * (1 + k * (-3.84e-4::DOUBLE + k * 7.57e-8::DOUBLE)) AS c FROM (SELECT *, 1 + d / 10 AS k FROM gr))",
)
def absorption_azfp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return absorption_of(spark, sf_dir, "AZFP")


# Speed.

SEGMENTS = f"""
    sg1 AS (SELECT *, CASE WHEN ping = 0 OR x <> lag(x) OVER w OR y <> lag(y) OVER w THEN 1 ELSE 0 END AS fix FROM tr WINDOW w AS (PARTITION BY line ORDER BY ping)),
    sg2 AS (SELECT *, sum(fix) OVER (PARTITION BY line ORDER BY ping) - 1 AS segment FROM sg1),
    sg3 AS (SELECT line, CAST(segment AS INT) AS segment, count(*) AS h_o, min(x) AS x, min(y) AS y FROM sg2 GROUP BY ALL),
    sg AS (SELECT * FROM (SELECT line, segment, h_o, CAST(floor(sqrt(power(lead(x) OVER w - x, 2) + power(lead(y) OVER w - y, 2)) / {RES / 3}::DOUBLE) AS BIGINT) AS h_r FROM sg3 WINDOW w AS (PARTITION BY line ORDER BY segment)) WHERE h_r IS NOT NULL)"""


@query(and_also(views.NAVIGATION, FILLED, PLANE, SEGMENTS), "SELECT line, segment, h_o, h_r FROM sg")
def speed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed.segments(plane_view(spark, sf_dir), RES / 3)


@query(and_also(views.NAVIGATION, FILLED, PLANE, SEGMENTS), "SELECT line, CAST(sum(h_r) AS BIGINT) AS n FROM sg GROUP BY line")
def speed_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after block-wise correction: as many as the segments want."""
    return speed.blockwise(plane_view(spark, sf_dir), RES / 3).groupBy("line").agg(F.count("*").alias("n"))


def overall_sql(res: float) -> str:
    return f"""
    tk AS (SELECT line, ping, ping * 0.375::DOUBLE AS x, ping * 0.5::DOUBLE AS y FROM numbered),
    st AS (SELECT line, ping, sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)) AS d FROM tk WINDOW w AS (PARTITION BY line ORDER BY ping)),
    sz AS (SELECT line, count(*) AS n, CAST(floor(sum(d) / {res}::DOUBLE) AS BIGINT) AS m FROM st GROUP BY line),
    ov AS (SELECT px.line, px.ping, k, v, n, m, unnest(range(px.ping * m // n, ((px.ping + 1) * m + n - 1) // n)) AS r FROM px JOIN sz USING (line) WHERE m > 0),
    mn AS (SELECT line, CAST(r AS INT) AS ping, k, sum((least((ping + 1) * m, (r + 1) * n) - greatest(ping * m, r * n)) * v) / any_value(n) AS v FROM ov GROUP BY line, r, k)"""


def overall_view(spark: SparkSession, sf_dir: str, res: float) -> DataFrame:
    rows = views.waterfall(spark, sf_dir).withColumns({"x": F.col("ping") * 0.375, "y": F.col("ping") * 0.5})
    return long(speed.overall(rows.withColumnRenamed("bs", "gray"), res), "gray").withColumn("v", rounded("v", 9))


@query(and_also(views.WATERFALL, overall_sql(RES)), "SELECT line, ping, k, round(v, 9) AS v FROM mn")
def speed_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer rows than pings: a row is longer than a step."""
    return overall_view(spark, sf_dir, RES)


@query(and_also(views.WATERFALL, overall_sql(0.23)), "SELECT line, ping, k, round(v, 9) AS v FROM mn")
def speed_overall_enlarged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than pings."""
    return overall_view(spark, sf_dir, 0.23)


# Geocoding.

PARTS = f"""
    nx AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM tr WINDOW w AS (PARTITION BY line ORDER BY ping)),
    pc AS (SELECT *, coalesce(greatest(1, CAST(ceil(sqrt(power(nx - x, 2) + power(ny - y, 2)) / {RES}::DOUBLE) AS INT)), 1) AS m FROM nx),
    su AS (SELECT *, sum(m) OVER (PARTITION BY line ORDER BY ping) AS until FROM pc),
    sp AS (SELECT line, ping, CAST(until - m + sub AS BIGINT) AS step, CAST(sub AS INT) AS sub, x + CAST(sub AS DOUBLE) / m * (coalesce(nx, x) - x) AS x, y + CAST(sub AS DOUBLE) / m * (coalesce(ny, y) - y) AS y FROM (SELECT *, unnest(range(0, m)) AS sub FROM su))"""


@query(and_also(views.NAVIGATION, FILLED, PLANE, PARTS), "SELECT line, ping, step, sub, round(x, 4) AS x, round(y, 4) AS y FROM sp")
def subping_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = geocode.subpings(plane_view(spark, sf_dir), RES)
    return parts.select("line", "ping", "step", "sub", rounded("x", 4).alias("x"), rounded("y", 4).alias("y"))


@query()
def subping_on_spline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-pings and their courses on the smoothing spline of each track."""
    track = navigation.spline_track(plane_view(spark, sf_dir), 80.0, "curve")
    parts = geocode.subpings(track, RES, curve="curve")
    return parts.select("line", "ping", "step", "sub", *(rounded(c, 4).alias(c) for c in ("x", "y", "heading")))


SPATIAL = """
    nv AS (SELECT line, ping, x, y FROM tr),
    sc AS (SELECT px.line, px.ping, k, x + (k - 32) * 80.0::DOUBLE / 32 * cos(radians((px.ping * 7) % 360)) AS x, y - (k - 32) * 80.0::DOUBLE / 32 * sin(radians((px.ping * 7) % 360)) AS y FROM px JOIN nv ON nv.line = px.line AND nv.ping = px.ping)"""


def spatial_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.waterfall(spark, sf_dir).join(plane_view(spark, sf_dir), ["line", "ping"])
    heading = ((F.col("ping") * 7) % 360).cast("double")
    each = rows.select("line", "ping", "x", "y", heading.alias("h"), F.size("bs").alias("n"), F.posexplode("bs").alias("k", "v"))
    at = geocode.spatial(F.col("x"), F.col("y"), F.col("h"), geocode.tow_distance(F.col("k"), F.col("n"), F.lit(80.0)))
    return each.select("line", "ping", "k", at[0].alias("x"), at[1].alias("y"))


@query(and_also(views.WATERFALL, views.NAVIGATION, FILLED, PLANE, SPATIAL), "SELECT line, ping, k, round(x, 4) AS x, round(y, 4) AS y FROM sc")
def tow_to_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial_view(spark, sf_dir).select("line", "ping", "k", rounded("x", 4).alias("x"), rounded("y", 4).alias("y"))


#: Turned by heading, then by roll, then by pitch, each axis written out.
TILTED = """
    an AS (SELECT px.line, px.ping, k, tr.x, tr.y, (k - 32) * 80.0::DOUBLE / 32 AS t, -((px.ping % 7)::DOUBLE) AS z, radians((px.ping * 7) % 360) AS h, radians((px.ping * 3) % 11 - 5) AS r, radians((px.ping * 5) % 9 - 4) AS p FROM px JOIN tr ON tr.line = px.line AND tr.ping = px.ping),
    rz AS (SELECT *, t * cos(h) AS x1, -t * sin(h) AS y1, z AS z1 FROM an),
    ry AS (SELECT *, cos(r) * x1 - sin(r) * z1 AS x2, y1 AS y2, -sin(r) * x1 + cos(r) * z1 AS z2 FROM rz),
    rx AS (SELECT *, x2 AS x3, cos(p) * y2 - sin(p) * z2 AS y3 FROM ry)"""


@query(and_also(views.WATERFALL, views.NAVIGATION, FILLED, PLANE, TILTED), "SELECT line, ping, k, round(x + x3, 4) AS x, round(y + y3, 4) AS y FROM rx")
def tow_to_spatial_tilted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of samples below a fish that rolls and pitches."""
    rows = views.waterfall(spark, sf_dir).join(plane_view(spark, sf_dir), ["line", "ping"])
    ping = F.col("ping")
    angles = {"h": (ping * 7) % 360, "r": (ping * 3) % 11 - 5, "p": (ping * 5) % 9 - 4, "z": -(ping % 7)}
    each = rows.select("line", "ping", "x", "y", *(c.cast("double").alias(n) for n, c in angles.items()), F.size("bs").alias("n"), F.posexplode("bs").alias("k", "v"))
    x, y = geocode.spatial(F.col("x"), F.col("y"), F.col("h"), geocode.tow_distance(F.col("k"), F.col("n"), F.lit(80.0)), F.col("r"), F.col("p"), F.col("z"))
    return each.select("line", "ping", "k", rounded(x, 4).alias("x"), rounded(y, 4).alias("y"))


@query(and_also(views.WATERFALL, BOTTOM), "SELECT line, round(sqrt(greatest(0, 6400.0::DOUBLE - power(80.0::DOUBLE - max(port_x) * (80.0::DOUBLE / 32), 2))), 6) AS reach FROM bt GROUP BY line")
def flat_range_of_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geocode.flat_range_of_depth(bottom_view(spark, sf_dir), RANGE, F.lit(32))
    return found.select("line", rounded("reach", 6).alias("reach"))


@query(
    and_also(views.WATERFALL, views.NAVIGATION, FILLED, PLANE, SPATIAL),
    "SELECT line, ping, k, CAST(trunc((900.0037::DOUBLE - y) / 0.7::DOUBLE) AS INT) AS \"row\", CAST(trunc((x + 100.0041::DOUBLE) / 0.7::DOUBLE) AS INT) AS col FROM sc",
)
def spatial_to_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col = geocode.pixel(F.col("x"), F.col("y"), F.lit(-100.0041), F.lit(900.0037), F.lit(0.7))
    return spatial_view(spark, sf_dir).select("line", "ping", "k", row.alias("row"), col.alias("col"))


def painted_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geocode.last_writer(views.painted(spark, sf_dir), views.PAINT_ORDER)


@query(and_also(views.PAINTED), 'SELECT line, "row", col, value FROM tile')
def paint_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return painted_tiles(spark, sf_dir)


@query(and_also(views.PAINTED, views.TILE_META), "SELECT min(ulx) AS ulx, max(uly) AS uly, min(res) AS res, CAST(ceil((max(uly) - min(uly - h * res)) / min(res)) AS INT) AS h, CAST(ceil((max(ulx + w * res) - min(ulx)) / min(res)) AS INT) AS w FROM meta")
def mosaic_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mosaic.extent(views.tile_meta(spark, sf_dir)).drop("epsg")


@query(and_also(views.PAINTED, views.TILE_META), 'SELECT CAST("row" + floor(500.0::DOUBLE - uly) AS INT) AS "row", CAST(col + floor(ulx - 100.0::DOUBLE) AS INT) AS col, max(value) AS value FROM tile JOIN meta USING (line) GROUP BY 1, 2')
def mosaic_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mosaic.merged(painted_tiles(spark, sf_dir), views.tile_meta(spark, sf_dir))


@query(and_also(views.PAINTED), "SELECT line, CAST(count(*) FILTER (value > 1) * 0.1::DOUBLE * 0.1::DOUBLE AS DOUBLE) AS area FROM tile GROUP BY line")
def scan_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.area(painted_tiles(spark, sf_dir), 0.1)


@query(
    "ends AS (SELECT l_orderkey, l_linenumber, l_partkey % 41 AS x0, l_suppkey % 37 AS y0, l_orderkey % 43 AS x1, l_partkey % 29 AS y1 FROM lineitem), n AS (SELECT *, greatest(abs(x1 - x0), abs(y1 - y0)) AS n, least(abs(x1 - x0), abs(y1 - y0)) AS s, abs(x1 - x0) < abs(y1 - y0) AS steep FROM ends), p AS (SELECT *, unnest(range(0, n + 1)) AS i FROM n), q AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE (2 * i * s + n) // (2 * n) END AS t FROM p)",
    "SELECT l_orderkey, l_linenumber, CAST(i AS INT) AS i, CAST(x0 + sign(x1 - x0) * CASE WHEN steep THEN t ELSE i END AS INT) AS x, CAST(y0 + sign(y1 - y0) * CASE WHEN steep THEN i ELSE t END AS INT) AS y FROM q",
)
def bresenham_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 41).alias("x0"), (F.col("l_suppkey") % 37).alias("y0"), (F.col("l_orderkey") % 43).alias("x1"), (F.col("l_partkey") % 29).alias("y1"))
    found = geocode.lines_of_sight(e, (F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")))
    return found.select("l_orderkey", "l_linenumber", "i", "x", "y")


def painted_track(spark: SparkSession, sf_dir: str) -> geocode.Swaths:
    """The waterfall along a bent track."""
    rows = views.waterfall(spark, sf_dir)
    gray = rows.select("line", "ping", F.transform("bs", lambda v: (1 + F.floor(v) % 255).cast("smallint")).alias("gray"), F.lit(20.0).alias("reach"))
    ping = F.col("ping").cast("long")  # its square passes an int's range from ping 46341 on
    track = rows.select("line", "ping", (500.0 + ping * 1.7).alias("x"), (300.0 + ping * 2.9 - ping * ping * 0.021).alias("y"))
    meta = geocode.tile_meta(gray.join(track, ["line", "ping"]), RES, 4499)
    return geocode.Swaths(gray, track, meta, RES)


#: The bent track, its parts and headings, and what they paint.
BENT = """
    tr AS (SELECT line, ping, 500.0::DOUBLE + ping * 1.7::DOUBLE AS x, 300.0::DOUBLE + ping * 2.9::DOUBLE - ping * ping * 0.021::DOUBLE AS y FROM numbered)"""
PAINTS = """
    hd AS (SELECT line, ping, degrees(atan2(coalesce(nx - x, x - lag(x) OVER w), coalesce(ny - y, y - lag(y) OVER w))) AS a FROM nx WINDOW w AS (PARTITION BY line ORDER BY ping)),
    co AS (SELECT line, min(x) - 20.0::DOUBLE AS ulx, max(y) + 20.0::DOUBLE AS uly FROM tr GROUP BY line),
    sa AS (SELECT sp.line, sp.ping, step, k, 1 + v % 255 AS v, x, y, radians(CASE WHEN a < 0 THEN a + 360.0::DOUBLE ELSE a END) AS a, (k - 32) * 20.0::DOUBLE / 32 AS t, ulx, uly FROM sp JOIN hd ON hd.line = sp.line AND hd.ping = sp.ping JOIN co ON co.line = sp.line JOIN px ON px.line = sp.line AND px.ping = sp.ping),
    pi AS (SELECT line, step, k, v, CAST(trunc((uly - (y - t * sin(a))) / 1.0::DOUBLE) AS INT) AS "row", CAST(trunc((x + t * cos(a) - ulx) / 1.0::DOUBLE) AS INT) AS col FROM sa),
    pn AS (SELECT *, lag("row") OVER w AS r0, lag(col) OVER w AS c0 FROM pi WINDOW w AS (PARTITION BY line, step ORDER BY k))"""


@query(and_also(views.WATERFALL, BENT, PARTS, PAINTS), 'SELECT line, "row", col, CAST(arg_max(v, (step, k)) AS SMALLINT) AS value FROM pn WHERE k = 0 OR "row" <> r0 OR col <> c0 GROUP BY line, "row", col')
def geocode_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return painted_track(spark, sf_dir).last_written()


@query()
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return painted_track(spark, sf_dir).filled()


@query()
def gap_fill_east_west(spark: SparkSession, sf_dir: str) -> DataFrame:
    return painted_track(spark, sf_dir).filled(is_ns=False)


# Quality control.


@query(
    and_also(views.WATERFALL, BOTTOM, "dp AS (SELECT line, ping, -(32.0::DOUBLE - port_x) * 2.5::DOUBLE AS p, -(stbd_x - 32.0::DOUBLE) * 2.5::DOUBLE AS s FROM bt)"),
    "SELECT line, ping, round(p, 6) AS port_depth, round(s, 6) AS stbd_depth, round(sqrt(greatest(0, 6400 - p * p)) + sqrt(greatest(0, 6400 - s * s)), 6) AS swath FROM dp",
)
def depth_swath(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = qc.depths(bottom_view(spark, sf_dir), 64, RANGE)
    return found.select("line", "ping", *(rounded(c, 6).alias(c) for c in ("port_depth", "stbd_depth", "swath")))


@query(
    and_also(views.WATERFALL, BOTTOM, "dp AS (SELECT line, -(32.0::DOUBLE - port_x) * 2.5::DOUBLE AS p FROM bt)"),
    "SELECT line, round_even(avg(p), 1) AS port_depth_mean, round_even(stddev_pop(p), 1) AS port_depth_std, round_even(max(p), 1) AS port_depth_max, round_even(min(p), 1) AS port_depth_min FROM dp GROUP BY line",
)
def depth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.statistic(qc.depths(bottom_view(spark, sf_dir), 64, RANGE), "port_depth")


@query(and_also(views.WATERFALL, BOTTOM), "SELECT line, quantile_cont(port_x, 0.25) AS q1, quantile_cont(port_x, 0.5) AS median, quantile_cont(port_x, 0.75) AS q3 FROM bt GROUP BY line")
def depth_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.quartiles(bottom_view(spark, sf_dir), "port_x")


@query(
    and_also(
        views.WATERFALL,
        "im AS (SELECT line, i AS image, CASE i WHEN 'raw' THEN v WHEN 'tvg' THEN sqrt(v) ELSE 1 + v % 255 END AS v FROM px CROSS JOIN (SELECT unnest(['raw', 'tvg', 'gray']) AS i))",
        "en AS (SELECT line, image, min(v) AS lo, max(v) AS hi, avg(v) AS mu, stddev_pop(v) AS sigma, count(*) AS n FROM im GROUP BY line, image)",
        "bi AS (SELECT line, image, CAST(least(255, floor((v - lo) / ((hi - lo) / 256))) AS INT) AS bin, count(*) AS c FROM im JOIN en USING (line, image) GROUP BY ALL)",
        "de AS (SELECT e.*, lo + b.bin * ((hi - lo) / 256) AS edge, coalesce(c, 0) / n / ((hi - lo) / 256) AS d FROM en e CROSS JOIN (SELECT CAST(unnest(range(0, 256)) AS INT) AS bin) b LEFT JOIN bi ON bi.line = e.line AND bi.image = e.image AND bi.bin = b.bin)",
    ),
    "SELECT line, image, round(any_value(mu), 6) AS mu, round(any_value(sigma), 6) AS sigma, round(sum(abs(d - exp(-0.5::DOUBLE * power((edge + CASE image WHEN 'gray' THEN 20 ELSE 0 END - mu) / sigma, 2)) / (sqrt(2 * pi()) * sigma))), 6) AS difference FROM de GROUP BY line, image",
)
def hist_three_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of three images of a line against their normal curves, the last one's moved by 20."""
    rows = views.waterfall(spark, sf_dir)
    made = {"raw": (rows, "bs", 0.0), "tvg": (rows.withColumn("bs", F.transform("bs", F.sqrt)), "bs", 0.0), "gray": (rows.withColumn("bs", F.transform("bs", lambda v: 1 + v % 255)), "bs", 20.0)}
    return qc.compared(qc.histograms(made)).select("line", "image", *(rounded(c, 6).alias(c) for c in ("mu", "sigma", "difference")))


@query(
    and_also(
        views.WATERFALL,
        "en AS (SELECT line, min(v) AS lo, max(v) AS hi, avg(v) AS mu, stddev_pop(v) AS sigma, count(*) AS n FROM px GROUP BY line)",
        "bi AS (SELECT line, CAST(least(255, floor((v - lo) / ((hi - lo) / 256))) AS INT) AS bin, count(*) AS c FROM px JOIN en USING (line) GROUP BY ALL)",
        "de AS (SELECT e.*, b.bin, lo + b.bin * ((hi - lo) / 256) AS edge, coalesce(c, 0) / n / ((hi - lo) / 256) AS d FROM en e CROSS JOIN (SELECT CAST(unnest(range(0, 256)) AS INT) AS bin) b LEFT JOIN bi ON bi.line = e.line AND bi.bin = b.bin)",
    ),
    "SELECT line, round(any_value(mu), 6) AS mu, round(any_value(sigma), 6) AS sigma, round(sum(abs(d - exp(-0.5::DOUBLE * power((edge - mu) / sigma, 2)) / (sqrt(2 * pi()) * sigma))), 6) AS difference FROM de GROUP BY line",
)
def hist_normal_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = qc.normal_difference(views.waterfall(spark, sf_dir), "bs")
    return found.select("line", *(rounded(c, 6).alias(c) for c in ("mu", "sigma", "difference")))


@query(and_also(views.WATERFALL, "dr AS (SELECT line, ping, row_number() OVER (PARTITION BY line ORDER BY md5('0:' || ping)) AS n FROM numbered)"), "SELECT line, ping, k, v FROM px JOIN dr USING (line, ping) WHERE n <= 2")
def drawn_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pings of each line, drawn by hash: sampling is the feature."""
    return long(speed.drawn_pings(views.waterfall(spark, sf_dir), 2), "bs")


@query()
def tile_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the waterfall and its positions to the summary of each line."""
    p = Params(slant_range=20.0, res=0.5, fish_trajectory_smooth_type="linear", bottom_offset=(0, 0))
    rows = views.waterfall(spark, sf_dir).join(views.navigation(spark, sf_dir), ["line", "ping"])
    ready = rows.withColumns({"heading": F.lit(10.0), "pitch": F.lit(0.0), "roll": F.lit(0.0), "course": F.lit(12.0)})
    return tile.quality(tile.build(ready, p), p)
