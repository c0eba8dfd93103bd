"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

With BENCH_LINES=1 besides, the stages of a tile over made-up lines of the published shapes: line_a 717 x 1736 and line_b 952 x 1736 samples.
"""

import json
import os
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = ["flagship_tvg_stretch", "ping_pairing_inner", "interpolate_repeats", "bottom_coarse", "bottom_smooth", "slant_correct", "gain_factor", "speed_segments", "paint_last_writer", "mosaic_max", "gap_fill"]


LINES = {"line_a": 717, "line_b": 952}
SAMPLES = 1736


def survey(spark: SparkSession, pings: int):
    """A straight line northward, 0.4 m a ping, with a water column of about 150 samples a side."""
    from pyspark.sql import functions as F

    away = lambda k: F.abs(k - (SAMPLES - 1) / 2)
    noise = lambda k: F.pmod(k * 7919 + F.col("ping") * 104729, F.lit(1000)) / 1000.0
    rows = spark.range(pings).select(F.lit("line").alias("line"), F.col("id").cast("int").alias("ping"))
    bs = F.transform(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda k: F.when(away(k) < 150 + 10 * F.sin(F.col("ping") / 40.0), noise(k) * 20).otherwise(400 + noise(k) * 600))
    fixed = {"lon": F.lit(119.8), "lat": F.lit(37.3) + F.col("ping") * 3.6e-6, "heading": F.lit(0.0), "pitch": F.lit(0.0), "roll": F.lit(0.0), "speed": F.lit(4.0), "course": F.lit(0.0)}
    return rows.withColumn("bs", bs).withColumns(fixed)


def stages(spark: SparkSession, name: str, pings: int) -> dict[str, float]:
    """Seconds of each stage over stored inputs."""
    from pyspark.sql import functions as F

    from seaswath.operators import gain, navigation, slant
    from seaswath.plans import tile
    from seaswath.types import Params

    p, folder, took = Params(), tile.workspace(spark), {}

    def timed(stage: str, df):
        began = time.time()
        out = tile.stored(df, folder, f"{name}-{stage}")
        took[f"{name}_{stage}"] = round(time.time() - began, 3)
        return out

    rows = tile.stored(survey(spark, pings), folder, f"{name}-input")
    track = timed("trajectory", navigation.prepared_track(rows.drop("bs"), p.fish_trajectory_smooth_type, p.track_s, p.geo_epsg, p.proj_epsg))
    gained = timed("tvg", tile.tvg(rows.select("line", "ping", "bs"), p))
    found = timed("bottom", tile.find_bottom(gained, p))
    flat = timed("slant", slant.correct(gained.withColumn("slant_width", F.size("bs")), found, p.bottom_offset))
    gray = timed("gray", gain.enhanced(flat, p.gray_enhance_method, ratio=p.ratio, prob_thred=p.prob_thred, gaussian_kernel=p.gaussian_kernel, gain=p.gain, alpha=p.alpha))
    made = tile.Tile(rows, track, found, flat, gray, gray, gray)
    timed("speed", tile.speed_corrected(made, p))
    timed("geocoding", tile.geocoded(gray, track, p)[0])
    return took


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    built = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
    spark = built.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from seaswath.plans.queries import QUERIES

    took = {}
    for name in HEADLINE:
        for _ in range(2):  # the second run counts: compiled code, started workers
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - began, 3)
    headline = round(sum(took.values()), 3)
    for name, pings in LINES.items() if os.environ.get("BENCH_LINES") else ():
        for _ in range(2):
            lines = stages(spark, name, pings)
        took |= lines
    print(json.dumps({"metric": "headline queries, warm", "value": headline, "unit": "sec", "queries": took, "sf": sf_dir.rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
