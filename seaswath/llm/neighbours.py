"""5. Nearest neighbours by additive quantisation.

A vector is its norm times a direction; a direction is approximated by the sum of one word from each of CODEBOOKS
full-dimensional codebooks, fitted to residuals of a bounded sample and chosen by beam search. Norm, code and error
(the distance of the approximation from the direction) are stored. A query's inner products with all codewords make
a lookup table; the sum of its entries at a vector's codes, times the norm, scores the vector, and its product is at
most that score and the query's norm times the vector's norm times the error. Each block rescores the RERANK rows of
the highest such bounds on original vectors in double precision, then all rows whose bound reaches the last one found,
so that the result is exact. Equal vectors are searched as one row and give their ids, in order, afterwards.
Only the inner product is searched, not the Euclidean distance.

Every row is indexed. Queries and rows are dealt into blocks; a task holds a block of rows and meets the
queries block by block, keeping each query's best.

Vectors null, empty, zero, or with null or non-finite components take no part, neither as queries nor as
candidates; vectors of different lengths are not candidates of each other, and each length has its own codebooks.
Ties go to the smaller id. A repeated id counts as a candidate once for each row; rows of the query's own id are not
its candidates; a repeated query id asks once for each different vector. Only key and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seaswath.llm.common import table, written

CODEBOOKS, WORDS, BEAM, SAMPLE, ROUNDS = 48, 256, 4, 8192, 4
EVERY, TOP, RERANK, ROW_BLOCK, QUERY_BLOCK, AT_ONCE = 20, 20, 64, 8192, 1024, 64


def takes_part(key: Column, vector: Column) -> Column:
    """Whether a row has a key and a vector of finite components, not all zero."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(key.isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and vector (array of double) of the rows that take part."""
    return df.where(takes_part(F.col(key), F.col(vector))).select(F.col(key), F.col(vector).cast("array<double>").alias(vector))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def sums(products: np.ndarray) -> np.ndarray:
    """Row sums, term after term, as SQL engines add."""
    return np.add.accumulate(products, axis=1)[:, -1]


@dataclass
class Codebooks:
    words: np.ndarray  # codebooks x words x dimensions

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes of directions by beam search: of all ways to go on from the best sums so far, the `beam` nearest go on."""
        rows = np.arange(len(x))
        left, codes = x.astype(np.float32)[:, None, :], np.zeros((len(x), 1, len(self.words)), np.uint8)
        cost = (left**2).sum(-1)
        for m, book in enumerate(self.words.astype(np.float32)):
            after = (left.reshape(-1, x.shape[1]) @ (-2 * book.T)).reshape(len(x), left.shape[1], len(book))
            after += (book**2).sum(1)
            after += cost[:, :, None]
            after = after.reshape(len(x), -1)
            picks, costs = [], []
            for _ in range(min(beam, after.shape[1])):
                picks.append(after.argmin(1))
                costs.append(after[rows, picks[-1]])
                after[rows, picks[-1]] = np.inf
            came, word = np.divmod(np.stack(picks, 1), len(book))
            codes = codes[rows[:, None], came]
            codes[:, :, m] = word
            left, cost = left[rows[:, None], came] - book[word], np.stack(costs, 1)
        return codes[:, 0]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The approximations."""
        return sum(book[codes[:, m]] for m, book in enumerate(self.words))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """codebooks x words x queries: inner products with every codeword."""
        return np.einsum("qd,mkd->mkq", q, self.words, optimize=True).astype(np.float32)

    def rounding(self) -> float:
        """More than what sums of single-precision table entries can be off, for a query of norm 1."""
        return float(1e-6 * len(self.words) * np.linalg.norm(self.words, axis=2).max(1).sum())


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and vectors of norm 1."""
    top = np.abs(x).max(1, keepdims=True)
    norms = top[:, 0] * np.linalg.norm(x / top, axis=1)
    return norms, x / norms[:, None]


def fit(sample: np.ndarray, codebooks: int = CODEBOOKS, words: int = WORDS) -> Codebooks:
    """Codebook after codebook: means of the residuals that the ones before leave."""
    rng, left, books = np.random.default_rng(7), sample.astype(np.float32), []
    for _ in range(codebooks):
        book = left[rng.choice(len(left), words, replace=len(left) < words)]
        for last in [False] * ROUNDS + [True]:
            near = ((book**2).sum(1) - 2 * left @ book.T).argmin(1)
            if last:
                break
            counts, order = np.bincount(near, minlength=words), np.argsort(near, kind="stable")
            totals = np.add.reduceat(left[order], np.minimum(np.cumsum(counts) - counts, len(left) - 1), axis=0)
            book = np.where(counts[:, None] > 0, totals / np.maximum(counts, 1)[:, None], book).astype(np.float32)
        left = left - book[near]
        books.append(book)
    return Codebooks(np.stack(books).astype(np.float64))


def train(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE) -> Codebooks:
    """Codebooks from the directions of the `sample` rows of the lowest hashes (a fixed bound); rows are of one length."""
    got = [r[0] for r in rows.orderBy(F.xxhash64(key), key, F.xxhash64(vector)).select(vector).limit(sample).collect()]
    return fit(directions(np.array(got))[1])


class Block:
    """A block of indexed rows, each with the ids of its copies."""

    def __init__(self, model: Codebooks, held: pd.DataFrame):
        self.model, self.ids = model, [np.asarray(i) for i in held["ids"]]
        self.codes = np.frombuffer(b"".join(held["code"]), np.uint8).reshape(len(held), -1).T.copy()
        self.vectors, self.norm = np.stack(held["v"].to_numpy()), held["norm"].to_numpy()
        self.reach = self.norm * (held["error"].to_numpy() + model.rounding())
        self.first, self.last = np.array([i[0] for i in self.ids]), np.array([i[-1] for i in self.ids])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """queries x rows: what no inner product is above."""
        scores = np.zeros((len(self.ids), len(queries)), np.float32)
        norms, units = directions(queries)
        for entries, column in zip(self.model.tables(units), self.codes, strict=True):
            scores += entries[column]
        return (scores.T * self.norm + self.reach) * norms[:, None]

    def nearest(self, q: int, v: np.ndarray, bound: np.ndarray, top: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products of the `top` nearest copies, without those of id q."""
        bound[(self.first == q) & (self.last == q)] = -np.inf
        k = min(max(top + 1, rerank), len(bound))
        near = np.argpartition(-bound, k - 1)[:k]
        near = near[np.isfinite(bound[near])]
        exact = sums(self.vectors[near] * v)
        if len(near) > top:  # all rows that may be above the last one found so far
            bound[near] = -np.inf
            more = np.flatnonzero(bound >= np.partition(exact, len(exact) - top - 1)[len(exact) - top - 1])
            near, exact = np.concatenate([near, more]), np.concatenate([exact, sums(self.vectors[more] * v)])
        kept = np.lexsort((self.first[near], -exact))[: top + 1]
        found = np.concatenate([np.zeros(0, np.int64), *(self.ids[j] for j in near[kept])])
        score = np.repeat(exact[kept], [len(self.ids[j]) for j in near[kept]])
        found, score = found[found != q], score[found != q]
        order = np.lexsort((found, -score))[:top]
        return found[order], score[order]


def searched(rows: DataFrame, every: int, top: int, rerank: int) -> DataFrame:
    """The search among rows (vec_id, v) of one length."""
    spark = rows.sparkSession
    model = spark.sparkContext.broadcast(train(rows, "vec_id", "v"))  # of fixed size

    @F.pandas_udf("code binary, norm double, error double")
    def code(vectors: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in vectors:
            parts = [pd.DataFrame({"code": pd.Series([], dtype=object), "norm": np.zeros(0), "error": np.zeros(0)})]
            for i in range(0, len(series), 512):
                norm, x = directions(np.stack(series.iloc[i : i + 512].to_numpy()))
                found = model.value.encode(x)
                parts.append(pd.DataFrame({"code": [c.tobytes() for c in found], "norm": norm, "error": np.linalg.norm(x - model.value.decode(found), axis=1)}))
            yield pd.concat(parts)

    # A row for each distinct vector, with the ids of its first top + 1 copies (each as often as it repeats, top times at most).
    copies = rows.groupBy("v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(top)).cast("int").alias("n"))
    copies = copies.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_r") <= top + 1)
    distinct = copies.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("vec_id", "n"))).alias("c"))
    distinct = distinct.select("v", F.flatten(F.transform("c", lambda c: F.array_repeat(c["vec_id"], c["n"]))).alias("ids"))
    # Stored, since the query blocks read them again: vectors with their codes.
    stored = written(distinct.withColumn("code", code("v")).select("v", "ids", "code.*"), "additive-codes")
    n = stored.count()
    asking = rows.where(F.col("vec_id") % every == 0).distinct()
    blocks, waves = max(1, -(-n // ROW_BLOCK)), max(1, -(-asking.count() // QUERY_BLOCK))
    wave = F.pmod(F.xxhash64("vec_id", "v"), F.lit(waves)).cast("int").alias("wave")
    asked = asking.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), wave, F.col("vec_id").alias("query_id"), "v")
    # The rows of a block meet each wave of queries in one task: blocks x waves of bounded size.
    block = F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block")
    held = stored.select(F.explode(F.sequence(F.lit(0), F.lit(waves - 1))).alias("wave"), block, "v", "ids", "code", "norm", "error")

    def scored(key, asking: pd.DataFrame, holding: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "row": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        own = Block(model.value, holding) if len(asking) and len(holding) else None
        for i in range(0, len(asking) if own else 0, AT_ONCE):
            part = asking.iloc[i : i + AT_ONCE]
            vectors = np.stack(part["v"].to_numpy())
            for q, row, v, bound in zip(part["query_id"], part["row"], vectors, own.bounds(vectors), strict=True):
                found, score = own.nearest(q, v, bound, top, rerank)
                out.append(pd.DataFrame({"query_id": q, "row": row, "vec_id": found, "score": score}))
        return pd.concat(out)

    asked = asked.withColumn("row", F.xxhash64("v"))
    scored_blocks = asked.groupBy("block", "wave").cogroup(held.groupBy("block", "wave")).applyInPandas(scored, "query_id long, row long, vec_id long, score double")
    ranked = scored_blocks.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def search(df: DataFrame, every: int = EVERY, top: int = TOP, rerank: int = RERANK, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest by inner product of every row whose key is divisible by `every`."""
    rows = usable(df, key, vector).select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())  # one for most tables
    found = [searched(rows.where(F.size("v") == n), every, top, rerank) for n in lengths]
    return reduce(DataFrame.unionByName, found, df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")) if len(found) != 1 else found[0]


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
