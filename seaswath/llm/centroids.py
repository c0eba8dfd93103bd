"""12. Centroid clustering by plain Lloyd rounds, in whole numbers.

Vectors with exactly `width` components, none null or non-finite, take part, each component x as floor(SCALE * x).
Each round broadcasts the centroids (k rows of `width` integers: a fixed size); mapInPandas computes every vector's
squared differences to each centroid, argmin takes the lowest number among equals, and each partition gives
one row a cluster: its count and componentwise sums, which a groupBy merges. Only these k * width sums reach the
driver. Means are exact floors, so that results do not depend on how rows are dealt out.

The first centroids are the k vectors with the smallest sha256 of `seed:id`; rows of one id are ordered by their
components, rows without an id come last. Fewer than k vectors give as many clusters, empty clusters keep their
centroid, repeated rows count each, rows without an id are vectors like others. Integers of BOUND or more in size
raise: their squared distances need not fit into a long. Only id and vector are read: further columns cannot clash.
Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm.common import discarded, frugal, table, written

SCALE, WIDTH, K, ROUNDS, SEED = 1024, 64, 8, 10, 3
#: 64 squared differences of integers below this size fit into 64 bits.
BOUND = 1 << 27


def members(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = WIDTH) -> DataFrame:
    """id, v: the vectors that take part."""
    finite = F.forall(F.col(vector), lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf")))
    return vectors.where((F.size(vector) == width) & finite).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))


def whole(vectors: pd.Series) -> np.ndarray:
    """A row of integers for each vector."""
    x = np.floor(np.stack(vectors.to_numpy()).astype(np.float64) * SCALE)
    if np.abs(x).max() >= BOUND:
        raise ArithmeticError(f"a component of {np.abs(x).max() / SCALE} is too large for whole distances")
    return x.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the lowest number among equals, and the squared distance to it."""
    distances = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
    best = distances.argmin(1)
    return best, distances[np.arange(len(x)), best]


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.orderBy(by.asc_nulls_last(), "v").limit(k).collect()  # k rows
    return whole(pd.Series([np.array(r.v) for r in rows], dtype=object)) if rows else np.zeros((0, 0), np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    held = kept.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        now = held.value
        count, total = np.zeros(len(now), np.int64), np.zeros(now.shape, np.int64)
        for batch in batches:
            if len(batch):
                x = whole(batch["v"])
                best, _ = nearest(x, now)
                for c in np.unique(best):
                    count[c] += (best == c).sum()
                    total[c] += x[best == c].sum(0)
        there = np.flatnonzero(count)
        yield pd.DataFrame({"cluster": there, "n": count[there], "sums": list(total[there])})

    each = kept.select("v").mapInPandas(run, "cluster int, n long, sums array<long>")
    parts = each.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    merged = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    out = centroids.copy()
    for r in merged.collect():  # at most k * width rows
        out[r.cluster, r["at"]] = int(r.total) // r.n
    held.destroy()
    return out


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, distance."""

    def run(batches):
        for batch in batches:
            if len(batch):
                best, distance = nearest(whole(batch["v"]), centroids)
                yield pd.DataFrame({"id": batch["id"], "cluster": best, "distance": distance})

    return kept.mapInPandas(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, key: str = "vec_id", vector: str = "embedding", width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of the vectors that take part, and the centroids."""
    frugal(vectors.sparkSession)
    kept = written(members(vectors, key, vector, width), "vectors")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(kept, centroids)
    out = written(assigned(kept, centroids), "clusters")
    discarded(kept)
    return out, centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(c, s, sum(sums.values()), marks[c]) for c, s in sums.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
