"""From sonar messages to pings: filter, unit conversion, pairing of port and starboard, downsampling.

Messages are rows of `types.MESSAGES`, or any table with line, seq, messagetype, subsystem, channel and a
struct `sonar`. Null channels count as neither side. Of repeated messages of one side of a ping the last
(by seq) counts. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seaswath.functions import arrays
from seaswath.operators.ordered import numbered
from seaswath.types import SONAR

#: Ping numbers that are numbered together.
BUCKET = 4096


def acoustic(messages: DataFrame, frequency: int) -> DataFrame:
    """The sonar messages of one frequency; both comparisons reach the scan."""
    return messages.where((F.col("messagetype") == SONAR) & (F.col("subsystem") == frequency))


def navigation(sonar: str = "sonar") -> list[Column]:
    """Position, attitude and speed in degrees and knots, rounded half to even."""
    c = lambda name: F.col(f"{sonar}.{name}").cast("double")
    return [
        F.bround(c("X") / 10000.0 / 60.0, 6).alias("lon"),
        F.bround(c("Y") / 10000.0 / 60.0, 6).alias("lat"),
        F.bround(c("heading") / 100.0, 4).alias("heading"),
        F.bround(c("pitch") / 32768.0 * 180.0, 4).alias("pitch"),
        F.bround(c("roll") / 32768.0 * 180.0, 4).alias("roll"),
        (c("nmeaspeed") / 10.0).alias("speed"),
        c("nmeacourse").alias("course"),
    ]


def sides(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(port, starboard): one row for each line and ping number that has the side, with the struct `message`."""
    rows = messages.where(F.col("channel").isNotNull()).withColumn("ping_number", F.col("sonar.pingnumber")).where(F.col("ping_number").isNotNull())
    # One aggregation per side combines map-side: the last message of a side wins.
    last = F.max_by(F.struct(*messages.columns), "seq").alias("message")
    port = rows.where("channel = 0").groupBy("line", "ping_number").agg(last)
    return port, rows.where("channel <> 0").groupBy("line", "ping_number").agg(last)


def paired(messages: DataFrame) -> DataFrame:
    """line, ping_number, port, starboard (structs of messages): the pings that have both sides."""
    port, starboard = sides(messages)
    return port.withColumnRenamed("message", "port").join(starboard.withColumnRenamed("message", "starboard"), ["line", "ping_number"])


def pairing_errors(messages: DataFrame) -> DataFrame:
    """line, ping_number, missing ('port' or 'starboard'): the pings that lack a side."""
    has = lambda condition: F.max(F.when(condition, 1).otherwise(0))
    rows = messages.withColumn("ping_number", F.col("sonar.pingnumber")).where(F.col("ping_number").isNotNull() & F.col("channel").isNotNull())
    found = rows.groupBy("line", "ping_number").agg(has(F.col("channel") == 0).alias("p"), has(F.col("channel") != 0).alias("s"))
    return found.where("p + s < 2").select("line", "ping_number", F.when(F.col("p") == 0, "port").otherwise("starboard").alias("missing"))


def leftovers(messages: DataFrame) -> DataFrame:
    """The messages that no pair uses: of incomplete pings, and earlier repeats."""
    used = paired(messages).select("line", F.explode(F.array("port.seq", "starboard.seq")).alias("seq"))
    return messages.join(used, ["line", "seq"], "left_anti")


def pings(messages: DataFrame, frequency: int) -> DataFrame:
    """A row per complete ping, numbered from 0 in each line: bs (port reversed, then starboard) and navigation of either side."""
    both = paired(acoustic(messages, frequency))
    bs = F.concat(F.reverse(F.col("port.sonardata")), F.col("starboard.sonardata")).alias("bs")
    stbd = [x.alias(f"stbd_{n}") for x, n in zip(navigation("starboard.sonar"), ("lon", "lat", "heading", "pitch", "roll", "speed", "course"), strict=True)]
    rows = both.select("line", "ping_number", bs, *navigation("port.sonar"), *stbd)
    return numbered(rows, ["line"], ["ping_number"], F.floor(F.col("ping_number") / BUCKET))


def stride_of(n_sample: Column, slant_range: float, res: float) -> Column:
    """Samples of a row that make one of the given resolution: at least 1."""
    return F.greatest(F.lit(1), F.floor(F.lit(res) / (F.lit(2.0 * slant_range) / n_sample)).cast("int"))


def downsample(pings: DataFrame, slant_range: float, res: float) -> DataFrame:
    return pings.withColumn("bs", arrays.stride(F.col("bs"), stride_of(F.size("bs"), slant_range, res)))


def latest_per_ping(messages: DataFrame) -> DataFrame:
    """One message for each line, channel and ping number: the last."""
    w = Window.partitionBy("line", "channel", "sonar.pingnumber").orderBy(F.desc("seq"))
    return messages.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
