"""Ordered operators on rows of a line, dealt out so that no line has to fit into one task.

A line's rows are cut into chunks of CHUNK pings. For a window of bounded reach, `halo` copies the rows
next to a chunk into it (no shuffle of its own: the place in the line says where a row goes); for
unbounded ones, chunks are summed up first and a small table of one row a chunk carries the result on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4096
LINE = "line"


def numbered(df: DataFrame, keys: list[str], order: list[str], bucket: Column, name: str = "ping") -> DataFrame:
    """df with a dense number from 0 in each group of keys; bucket must rise with the order."""
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return rows.join(base, [*keys, "_bucket"]).withColumn(name, (F.col("_base") + place - 1).cast("int")).drop("_bucket", "_base")


def halo(df: DataFrame, before: int, after: int, size: int = CHUNK) -> DataFrame:
    """df with _chunk, where rows stand in each chunk that needs them, and _own: whether a chunk is the row's own."""
    size = max(size, before, after)
    own, place = F.floor(F.col("ping") / size).cast("int"), F.pmod(F.col("ping"), F.lit(size))
    where = F.array_compact(F.array(own, F.when((place < after) & (own > 0), own - 1), F.when(size - place <= before, own + 1)))
    return df.withColumn("_own_chunk", own).withColumn("_chunk", F.explode(where)).withColumn("_own", F.col("_chunk") == F.col("_own_chunk")).drop("_own_chunk")


def in_chunk() -> Window:
    return Window.partitionBy(LINE, "_chunk").orderBy("ping")


def owned(df: DataFrame) -> DataFrame:
    """The rows' own copies, after the windows are computed."""
    return df.where("_own").drop("_own", "_chunk")


def filled(df: DataFrame, valid: Column, columns: list[str], size: int = CHUNK) -> DataFrame:
    """Rows that are not valid take the columns of the last valid row before them in the line, else of the first one after."""
    names = [f"_{c}" for c in columns]
    value = F.when(valid, F.struct(*(F.col(c).alias(n) for c, n in zip(columns, names, strict=True))))
    rows = df.withColumn("_chunk", F.floor(F.col("ping") / size).cast("int")).withColumn("_value", value)
    known = F.col("_value").isNotNull()
    chunks = rows.groupBy(LINE, "_chunk").agg(F.max_by("_value", F.when(known, F.col("ping"))).alias("_end"), F.min_by("_value", F.when(known, F.col("ping"))).alias("_start"))
    w = Window.partitionBy(LINE).orderBy("_chunk")
    carry = chunks.select(
        LINE,
        "_chunk",
        F.last("_end", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_start", True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("_after"),
    )
    last = F.last("_value", True).over(in_chunk().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = rows.withColumn("_value", last).join(carry, [LINE, "_chunk"])
    best = F.coalesce("_value", "_before", "_after")
    return found.withColumns({c: best.getField(n) for c, n in zip(columns, names, strict=True)}).select(*df.columns)


def running_sum(df: DataFrame, value: Column, name: str, size: int = CHUNK) -> DataFrame:
    """df with the sum of value over the line's rows up to each one."""
    rows = df.withColumn("_chunk", F.floor(F.col("ping") / size).cast("int")).withColumn("_x", value)
    before = Window.partitionBy(LINE).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(LINE, "_chunk").agg(F.sum("_x").alias("_s")).select(LINE, "_chunk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    up_to = F.sum("_x").over(in_chunk().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn(name, up_to).join(base, [LINE, "_chunk"]).withColumn(name, F.col(name) + F.col("_base")).drop("_chunk", "_x", "_base")
