"""The stages of a survey as Spark jobs over tables: ingest, tile construction, stitching.

Each stage takes and gives DataFrames; `run_*` also read and write folders that the cluster shares.
Stage results that later stages read more than once are written as Parquet, which cuts lineage and
survives lost executors.
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.functions import acoustics
from seaswath.operators import bottom, gain, geocode, ingest, mosaic, navigation, qc, repair, slant, speed, stretch
from seaswath.operators.ordered import LINE
from seaswath.plans import store
from seaswath.sources import raster
from seaswath.sources.tables import stored, workspace
from seaswath.types import Params

log = logging.getLogger("seaswath")
PING = "line string, ping int, ping_number long, bs array<double>, lon double, lat double, heading double, pitch double, roll double, speed double, course double"


@dataclass
class Tile:
    """Tables of a run, by stage."""

    pings: DataFrame
    track: DataFrame
    bottom: DataFrame
    flat: DataFrame
    gray: DataFrame
    pixels: DataFrame
    meta: DataFrame


def alpha(p: Params) -> Column:
    return acoustics.absorption(p.frequency_hz, p.temperature, p.salinity, p.depth, p.pH)


def tvg(pings: DataFrame, p: Params) -> DataFrame:
    return pings.withColumn("bs", acoustics.tvg(F.col("bs"), p.slant_range, p.lambd, alpha(p)))


def find_bottom(gained: DataFrame, p: Params) -> DataFrame:
    found = bottom.detect(gained, p.gradient_thred_factor, p.win_h, p.compat)
    if p.use_ab_line_correction:
        widths = gained.groupBy(LINE).agg(F.max(F.size("bs")).alias("n_sample"))  # a row for each line
        found = bottom.smoothed(repair.repair(found, widths, p.peak_factor, p.valley_std))
    return found


def flat_gray(gained: DataFrame, found: DataFrame, p: Params, folder: str) -> tuple[DataFrame, DataFrame]:
    """(ground-range rows, the same with gray)."""
    flat = stored(slant.correct(gained, found, p.bottom_offset), folder, "flat")
    return flat, gain.enhanced(flat, p.gray_enhance_method, ratio=p.ratio, prob_thred=p.prob_thred, gaussian_kernel=p.gaussian_kernel, gain=p.gain, alpha=p.alpha)


def geocoded(gray: DataFrame, track: DataFrame, p: Params, fill: bool = True) -> tuple[DataFrame, DataFrame]:
    """(pixels, meta): track has line, ping, x, y; gray has gray, slant_width."""
    angled, angle = geocode.course(track, p.angle, p.angle_s)
    reach = geocode.flat_range(p.slant_range, F.col("slant_width"), F.size("gray"))
    rows = gray.select(LINE, "ping", "gray", reach.alias("reach"))
    if not p.level:
        rows = rows.join(track.select(LINE, "ping", "roll", "pitch"), [LINE, "ping"])
    meta = geocode.tile_meta(rows.select(LINE, "ping", "reach").join(track.select(LINE, "ping", "x", "y"), [LINE, "ping"]), p.res, p.proj_epsg)
    curve = "curve" if "curve" in track.columns else None
    swaths = geocode.Swaths(rows, angled, meta, p.res, "gray", angle, curve, "angle_curve" if angle else None)
    return (swaths.filled(p.is_ns) if fill else swaths.last_written()), meta


def build(pings: DataFrame, p: Params, folder: str | None = None) -> Tile:
    """All stages of tile construction over downsampled pings of any number of lines."""
    folder = folder or workspace(pings.sparkSession)
    pings = stored(pings, folder, "input")
    track = stored(navigation.prepared_track(pings.drop("bs"), p.fish_trajectory_smooth_type, p.track_s, p.geo_epsg, p.proj_epsg), folder, "track")
    gained = stored(tvg(pings.select(LINE, "ping", "bs"), p), folder, "tvg")
    found = stored(find_bottom(gained, p), folder, "bottom")
    flat, gray = flat_gray(gained.withColumn("slant_width", F.size("bs")), found, p, folder)
    gray = stored(gray, folder, "gray")
    pixels, meta = geocoded(gray, track, p)
    return Tile(pings, track, found, flat, gray, stored(pixels, folder, "pixels"), stored(meta, folder, "tile_meta"))


def speed_corrected(tile: Tile, p: Params, seed: int = 0) -> DataFrame:
    """Gray rows at true along-track scale, by filled and projected positions (unsmoothed)."""
    fixes = navigation.projected(navigation.fill_positions(tile.pings.select(LINE, "ping", "lon", "lat")), p.geo_epsg, p.proj_epsg)
    rows = tile.gray.select(LINE, "ping", "gray").join(fixes.select(LINE, "ping", "x", "y"), [LINE, "ping"])
    return speed.corrected(rows, p.speed_correction_method, p.res, seed)


def quality(tile: Tile, p: Params, seconds: float | None = None) -> DataFrame:
    columns = [LINE, "ping", "lon", "lat", *dict.fromkeys(["heading", "speed", *([p.angle] if p.angle != "cog" else [])]), "bs"]
    raw = tile.pings.select(*columns)
    smoothed, angle = geocode.course(tile.track, p.angle, p.angle_s)
    return qc.summary(raw, raw, tile.bottom, tile.pixels, p, navigation.line_lengths(tile.track), smoothed if angle else None, seconds)


def histograms(tile: Tile, gained: DataFrame, p: Params) -> DataFrame:
    """The raw and the gained waterfall, both stretched, and the enhanced one, whose normal curve is moved by 20 levels as published."""
    stretched = {name: stretch.linear_stretch(rows.select(LINE, "ping", "bs"), p.ratio) for name, rows in (("raw", tile.pings), ("tvg", gained))}
    return qc.histograms({**{name: (rows, "gray", 0.0) for name, rows in stretched.items()}, "gray": (tile.gray, "gray", 20.0)})


def run_ingest(spark: SparkSession, source: str, out: str, p: Params, mode: str = "FAILFAST") -> DataFrame:
    """JSF files to messages, raw pings and downsampled pings, as Parquet by line; only new and changed files are read."""
    read = store.update(spark, source, out, p, mode)
    log.info("%d files read", read)
    return read_pings(spark, out)


def read_pings(spark: SparkSession, folder: str) -> DataFrame:
    return store.read(spark, folder, "pings")


def run_tiles(spark: SparkSession, folder: str, p: Params, sinks: bool = True) -> Tile:
    began = time.time()
    tile = build(read_pings(spark, folder), p, folder)
    if sinks:
        raster.save(raster.geotiffs(tile.pixels, tile.meta, f"_{p.frequency}-bs-geocoding"), f"{folder}/geocoding")
        raster.save(raster.pngs(tile.gray, suffix="-gray"), f"{folder}/gray_png")
        seen = bottom.overlay(stretch.linear_stretch(spark.read.parquet(f"{folder}/tvg"), p.ratio).select(LINE, "ping", "gray"), tile.bottom)
        raster.save(raster.pngs(seen, suffix="-bottom", marks="marks"), f"{folder}/bottom_png")
        raster.save(raster.pngs(speed_corrected(tile, p), suffix="-speed"), f"{folder}/speed_png")
        raster.bottom_text(tile.bottom, f"{folder}/bottom_text")
    histograms(tile, spark.read.parquet(f"{folder}/tvg"), p).write.mode("overwrite").partitionBy("image").parquet(f"{folder}/qc_histograms")
    quality(tile, p, round(time.time() - began, 2)).write.mode("overwrite").parquet(f"{folder}/qc_summary")
    log.info("tiles of %s took %.1f s", folder, time.time() - began)
    return tile


def run_stitch(spark: SparkSession, folder: str, p: Params, name: str = "mosaic") -> DataFrame:
    meta = spark.read.parquet(f"{folder}/tile_meta")
    cells = stored(mosaic.merged(spark.read.parquet(f"{folder}/pixels"), meta), folder, "mosaic")
    one = mosaic.extent(meta).withColumn(LINE, F.lit(name))
    raster.save(raster.geotiffs(cells.withColumn(LINE, F.lit(name)), one, ""), f"{folder}/mosaic_tif")
    return cells


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=["ingest", "tile", "stitch"])
    parser.add_argument("folder", help="shared folder of the run")
    parser.add_argument("--source", help="folder of .jsf files (ingest)")
    parser.add_argument("--out_file_name", default="mosaic")
    for f in fields(Params):
        kind = {"int": int, "float": float, "str": str}.get(f.type)
        if f.name == "bottom_offset":
            parser.add_argument("--bottom_offset", type=int, nargs=2, default=f.default)
        elif f.type == "bool":
            parser.add_argument(f"--{f.name}", type=int, choices=[0, 1], default=int(f.default))
        else:
            parser.add_argument(f"--{f.name}", type=kind, default=f.default)
    a = parser.parse_args(args)
    values = {f.name: getattr(a, f.name) for f in fields(Params)}
    p = Params(**{k: tuple(v) if k == "bottom_offset" else bool(v) if k in ("is_ns", "compat", "use_ab_line_correction", "level", "recorded_speed") else v for k, v in values.items()})
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    log.info("%s", p)
    spark = SparkSession.builder.appName("seaswath").getOrCreate()
    if a.stage == "ingest":
        if not a.source:
            parser.error("ingest needs --source")
        run_ingest(spark, a.source, a.folder, p)
    elif a.stage == "tile":
        run_tiles(spark, a.folder, p)
    else:
        run_stitch(spark, a.folder, p, a.out_file_name)


if __name__ == "__main__":
    main()
