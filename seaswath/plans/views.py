"""Sonar-shaped views of general tables, for queries whose results SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.operators.ordered import numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, ping, bs: vectors as rows of 64 whole-number samples, their labels as lines."""
    rows = table(spark, sf_dir, "embeddings").where("label IS NOT NULL AND embedding IS NOT NULL").select(F.col("label").alias("line"), "vec_id", "embedding")
    bs = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000.0).cast("double"))
    return numbered(rows, ["line"], ["vec_id"], F.floor(F.col("vec_id") / 65536)).select("line", "ping", bs.alias("bs"))


WATERFALL = """
    numbered AS (SELECT label AS line, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INT) AS ping, embedding FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
    px AS (SELECT line, ping, CAST(k AS INT) AS k, floor(abs(CAST(embedding[k + 1] AS DOUBLE)) * 1000.0::DOUBLE) AS v FROM numbered CROSS JOIN range(0, 64) r(k)),
    half AS (SELECT line, ping, k, v, CASE WHEN k < 32 THEN 'port' ELSE 'stbd' END AS side, CASE WHEN k < 32 THEN 31 - k ELSE k - 32 END AS j FROM px)"""


def navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, ping, lon, lat, speed: events as fixes of ten lines, each fix repeated for four pings, errors as missing values."""
    events = table(spark, sf_dir, "events").withColumn("line", (F.col("user_id") % 10).cast("int"))
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    rows = numbered(events, ["line"], ["ts", "event_id"], day)
    missing, block = F.col("event_type") == "error", F.col("ping") - F.col("ping") % 4
    return rows.select(
        "line",
        "ping",
        F.when(missing, 0.0).otherwise(F.lit(119.0) + block * F.lit(1e-5)).alias("lon"),
        F.when(missing, 0.0).otherwise(F.lit(37.0) + block * F.lit(2e-5)).alias("lat"),
        F.when(missing, 0.0).otherwise(F.floor("value").cast("double")).alias("speed"),
    )


NAVIGATION = """
    ordered AS (SELECT CAST(user_id % 10 AS INT) AS line, CAST(row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) - 1 AS INT) AS ping, event_type = 'error' AS missing, value FROM events),
    nav AS (SELECT line, ping,
        CASE WHEN missing THEN 0.0::DOUBLE ELSE 119.0::DOUBLE + (ping - ping % 4) * 1e-5::DOUBLE END AS lon,
        CASE WHEN missing THEN 0.0::DOUBLE ELSE 37.0::DOUBLE + (ping - ping % 4) * 2e-5::DOUBLE END AS lat,
        CASE WHEN missing THEN 0.0::DOUBLE ELSE floor(value) END AS speed FROM ordered)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of one line: line, seq, messagetype, subsystem, channel, sonar."""
    e = table(spark, sf_dir, "events")
    i, v = F.col("event_id"), F.floor("value").cast("long")
    sonar = F.struct(
        F.floor(i / 2).cast("long").alias("pingnumber"),
        (i * 7).cast("int").alias("X"),
        (i * 11).cast("int").alias("Y"),
        (i % 36000).cast("int").alias("heading"),
        (v % 3000).cast("int").alias("pitch"),
        (i % 777).cast("int").alias("roll"),
        v.alias("nmeaspeed"),
        (i % 360).cast("int").alias("nmeacourse"),
    )
    kind = F.when(F.col("event_type") == "signup", 82).otherwise(80)
    return e.select(F.lit("events").alias("line"), i.alias("seq"), kind.alias("messagetype"), (20 + F.col("user_id") % 2).cast("int").alias("subsystem"), (i % 2).cast("int").alias("channel"), sonar.alias("sonar"))


MESSAGES = """
    msg AS (SELECT event_id AS seq, CASE WHEN event_type = 'signup' THEN 82 ELSE 80 END AS messagetype, CAST(20 + user_id % 2 AS INT) AS subsystem, CAST(event_id % 2 AS INT) AS channel,
        event_id // 2 AS ping_number, event_id * 7 AS x, event_id * 11 AS y, event_id % 36000 AS heading, CAST(floor(value) AS BIGINT) % 3000 AS pitch, event_id % 777 AS roll, CAST(floor(value) AS BIGINT) AS speed, event_id % 360 AS course FROM events)"""


def painted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, row, col, value and the columns that order them: order lines as paints on five tiles."""
    i = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return i.select((F.col("l_suppkey") % 5).cast("int").alias("line"), (F.col("l_partkey") % 64).cast("int").alias("row"), (F.col("l_orderkey") % 64).cast("int").alias("col"), (1 + F.floor(F.col("l_quantity") * 5.0)).cast("int").alias("value"), *order)


PAINT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
PAINTED = """
    paint AS (SELECT CAST(l_suppkey % 5 AS INT) AS line, CAST(l_partkey % 64 AS INT) AS "row", CAST(l_orderkey % 64 AS INT) AS col, CAST(1 + floor(l_quantity * 5.0::DOUBLE) AS INT) AS value, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
    tile AS (SELECT line, "row", col, arg_max(value, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS value FROM paint GROUP BY ALL)"""


def tile_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five tiles' places: as large as what is painted on them, a metre a pixel, each half over the one before."""
    ends = painted(spark, sf_dir).groupBy("line").agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"))
    return ends.select("line", (F.col("line") * 32.0 + 100.0).alias("ulx"), (F.lit(500.0) - F.col("line") * 16.0).alias("uly"), F.lit(1.0).alias("res"), "h", "w", F.lit(4499).alias("epsg"))


TILE_META = """
    meta AS (SELECT line, line * 32.0::DOUBLE + 100.0::DOUBLE AS ulx, 500.0::DOUBLE - line * 16.0::DOUBLE AS uly, 1.0::DOUBLE AS res, max("row") + 1 AS h, max(col) + 1 AS w FROM paint GROUP BY line)"""
