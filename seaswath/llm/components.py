"""Connected components of links between ids, as rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seaswath.llm.common import discarded, written


def reached(now: DataFrame) -> DataFrame:
    """u, p: for every id of the links u, v the smallest one within two links."""
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    near = written(both.join(least.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("m").alias("p")), "reached")
    discarded(least)
    return near


def ended(near: DataFrame) -> DataFrame:
    """u, p of pointers u, p followed to their ends, by doubling."""
    while True:
        ends = near.select(F.col("u").alias("p"), F.col("p").alias("end"))
        further = written(near.join(ends, "p").select("u", F.col("end").alias("p"), (F.col("end") != F.col("p")).alias("moved")), "pointers")
        discarded(near)
        near = further.select("u", "p")
        if not further.where("moved").limit(1).count():
            return near


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: for every id with a link, the smallest id it reaches. links are read several times: give a written table.

    In each round an id points to the smallest one within two links, and links are drawn together to what their ends
    point to, until none is left: as a rule at once, where groups are bunches around a few of their ids. From the second
    round on pointers are followed to their ends. An end that no other id points to then has smaller neighbours only and is
    none in the next round, so that two rounds leave at most half of the ids, also of long chains.
    An id with very many neighbours is aggregated map-side, written, and joined back by a join that Spark can
    split. No links give no rows; loops and repeats are dropped.
    """

    def ordered(x, y):
        return F.greatest(x, y).alias("u"), F.least(x, y).alias("v")

    now, rounds = links.where(F.col(a) != F.col(b)).select(*ordered(F.col(a), F.col(b))), []
    while True:
        near = ended(reached(now)) if rounds else reached(now)
        x, y = near.select("u", F.col("p").alias("x")), near.select(F.col("u").alias("v"), F.col("p").alias("y"))
        after = written(now.join(x, "u").join(y, "v").where("x != y").select(*ordered(F.col("x"), F.col("y"))).distinct(), "links")
        if rounds:
            discarded(now)
        now, rounds = after, [*rounds, near]
        if not now.limit(1).count():
            break
    discarded(now)
    found = rounds[0].select(F.col("u").alias("id"), F.col("p").alias("component"))
    if len(rounds) == 1:
        return found
    for near in rounds[1:]:
        found = found.join(near.withColumnRenamed("u", "component"), "component", "left").select("id", F.coalesce("p", "component").alias("component"))
    found = written(found, "components")
    for near in rounds:
        discarded(near)
    return found
