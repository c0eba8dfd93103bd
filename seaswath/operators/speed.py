"""Along-track speed correction: rows repeated or left out until a row is as long as the resolution.

Rows have line, ping (dense from 0), x and y (filled and projected) besides their data. Which rows of a
segment are repeated once more (or stay) is drawn by a hash of seed and ping: the same for every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seaswath.operators.navigation import line_lengths, marked_fixes
from seaswath.operators.ordered import LINE, halo, in_chunk, numbered, owned, running_sum
from seaswath.sources.tables import stored, workspace


def with_segments(rows: DataFrame) -> DataFrame:
    """line, ping, x, y, segment of rows: the number of position fixes before or at a ping, from 0. Written once: it is read several times."""
    narrow = marked_fixes(rows.select(LINE, "ping", "x", "y"), ["x", "y"], "_fix")
    counted = running_sum(narrow, F.col("_fix").cast("long"), "segment").select(LINE, "ping", "x", "y", (F.col("segment") - 1).cast("int").alias("segment"))
    return stored(counted, workspace(rows.sparkSession), "segments")


def segments_of(marked: DataFrame, res: float) -> DataFrame:
    """line, segment, h_o (pings), h_r (rows wanted): between successive fixes; what follows the last one is left out."""
    sizes = marked.groupBy(LINE, F.col("segment")).agg(F.count("*").alias("h_o"), F.first("x").alias("x"), F.first("y").alias("y"))
    steps = halo(sizes.withColumn("ping", F.col("segment")), 0, 1)
    dx, dy = F.lead("x").over(in_chunk()) - F.col("x"), F.lead("y").over(in_chunk()) - F.col("y")
    measured = owned(steps.withColumn("_d", F.sqrt(dx * dx + dy * dy))).where("_d IS NOT NULL")
    return measured.select(LINE, "segment", "h_o", F.floor(F.col("_d") / res).cast("long").alias("h_r"))


def segments(rows: DataFrame, res: float) -> DataFrame:
    return segments_of(with_segments(rows), res)


def copies(rank: Column) -> Column:
    """How often a row stands in the result: h_r div h_o times, once more for as many as are left over."""
    fold = F.floor(F.col("h_r") / F.col("h_o"))
    return fold + F.when(rank < F.col("h_r") - fold * F.col("h_o"), 1).otherwise(0)


def blockwise(rows: DataFrame, res: float, seed: int = 0) -> DataFrame:
    """rows (without x, y) with source_ping and a new dense ping."""
    marked = with_segments(rows)
    wanted = marked.join(segments_of(marked, res), [LINE, "segment"]).withColumn("_h", F.xxhash64(F.lit(seed), F.col("ping")))
    # Ranked by hash, and by the hash's upper bits in buckets: a segment of very many pings is dealt out.
    ranked = numbered(wanted, [LINE, "segment"], ["_h"], F.shiftright("_h", 54), "_rank")
    repeated = ranked.withColumn("_n", copies(F.col("_rank")).cast("int")).where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    again = repeated.select(LINE, F.col("ping").alias("source_ping"), "_copy")
    # Rows are numbered by themselves and meet their data last.
    done = numbered(again, [LINE], ["source_ping", "_copy"], F.floor(F.col("source_ping") / 1024)).drop("_copy")
    return rows.drop("x", "y").withColumnRenamed("ping", "source_ping").join(done, [LINE, "source_ping"])


def overall(rows: DataFrame, res: float, seed: int = 0, column: str = "gray") -> DataFrame:
    """line, ping, `column`: as many rows as the track's length in units of res, each the mean of the pings that it covers, weighted by overlap.

    With n pings and m rows, a ping reaches from ping * m to (ping + 1) * m and a row from r * n to (r + 1) * n: whole
    numbers, so that shares are exact whether rows become fewer or more.
    """
    size = line_lengths(rows).join(rows.groupBy(LINE).agg((F.max("ping") + 1).cast("long").alias("_n")), LINE).select(LINE, "_n", F.floor(F.col("length") / res).alias("_m")).where("_m > 0")
    ping, n, m, r = F.col("ping").cast("long"), F.col("_n"), F.col("_m"), F.col("_r")
    low, high = ping * m, (ping + 1) * m
    sized = rows.select(LINE, "ping", column).join(size, LINE).withColumn("_r", F.explode(F.sequence(F.floor(low / n), F.ceil(high / n) - 1)))
    weight = F.least(high, (r + 1) * n) - F.greatest(low, r * n)
    each = sized.select(LINE, "_r", n, weight.alias("_w"), F.posexplode(column).alias("_k", "_v")).where("_w > 0")
    # Sums of samples combine map-side: a standing vessel's many pings never meet in one group.
    means = each.groupBy(LINE, "_r", "_k").agg((F.sum(F.col("_w") * F.col("_v")) / F.sum("_w")).alias("_v"))
    packed = means.groupBy(LINE, F.col("_r").cast("int").alias("ping")).agg(F.array_sort(F.collect_list(F.struct("_k", "_v"))).alias("_s"))
    return packed.select(LINE, "ping", F.col("_s._v").alias(column))


METHODS: dict[str, Callable[..., DataFrame]] = {"blockwise": blockwise, "overall": overall}


def corrected(rows: DataFrame, method: str, res: float, seed: int = 0) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown speed correction {method}: one of {sorted(METHODS)}")
    return METHODS[method](rows, res, seed)


def drawn_pings(rows: DataFrame, k: int = 2, seed: int = 0) -> DataFrame:
    """k pings of each line, drawn by hash (a sample is the feature here)."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("ping").cast("string")))
    # The k smallest hashes, one after another by aggregates that combine map-side.
    left, chosen = rows.select(LINE, "ping", order.alias("h")), None
    for _ in range(k):
        best = left.groupBy(LINE).agg(F.min(F.struct("h", "ping")).alias("_m")).select(LINE, F.col("_m.ping").alias("ping"))
        chosen = best if chosen is None else chosen.unionByName(best)
        left = left.join(best, [LINE, "ping"], "left_anti")
    return rows.join(chosen, [LINE, "ping"], "left_semi")
