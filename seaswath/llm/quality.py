"""2. Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text (characters by class, words, repeats, lines) are computed in Arrow batches.
Trees are grown on quantile bins from a bounded sample of labelled documents (SAMPLE rows, those of the
lowest hash), then flattened into arrays that numpy traverses for a whole batch at a time.

Null and empty texts have zero statistics and get the score the trees give those. Null labels are not
learned from; with no usable label every score is 0.5. Repeated rows get equal scores; a doc_id that repeats among
documents is learned from by its least text, one labelled twice by its smaller label. A null doc_id is not held out.
Equal statistics get equal scores; the best split of equal ones is the first. Very long texts are one row of their
batch. Only doc_id, text and the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from seaswath.llm.common import fold, frugal, table

SAMPLE, FOLDS, THRESHOLD = 20_000, 5, 0.3
TREES, DEPTH, BINS, RATE, LEAST, SMOOTH = 60, 4, 64, 0.2, 20, 1.0
#: Characters counted one by one as shares of a text's bytes.
MARKS = "#$%&*!|.,:;?'\"-_/\\(){}[]<>@+=~^`"


def statistics(text: str | None) -> np.ndarray:
    """The features of one whole text."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    total = max(1, int(raw.sum()))
    words = text.split()
    n, distinct = max(1, len(words)), len(set(words))
    lines = text.split("\n")
    repeats = sum(map(str.__eq__, words, words[1:]))
    spans = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    marks = raw[np.frombuffer(MARKS.encode(), np.uint8)]
    upper, lower, digits = raw[65:91].sum(), raw[97:123].sum(), raw[48:58].sum()
    top = [np.log1p(len(text)), np.log1p(len(words)), spans.mean(), spans.std(), spans.max(), distinct / n, repeats / n, len(lines) / n, len(set(lines)) / len(lines), upper / total, upper / max(1, upper + lower), digits / total, raw[128:].sum() / total, raw[32] / total, marks.sum() / total, marks.max() / n]
    return np.concatenate([top, marks / total]).astype(np.float32)


N_FEATURES = len(statistics(""))


@F.pandas_udf(ArrayType(FloatType()))
def text_statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in texts:
        yield pd.Series([statistics(t) for t in series])


class Trees:
    """Boosted trees of one depth as arrays: node j of a tree splits feature[j] at edge[j]; its children are 2j+1 and 2j+2."""

    def __init__(self, base: float, feature: np.ndarray, edge: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.edge, self.leaf = base, feature, edge, leaf

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows, inner = np.full(len(x), self.base), np.arange(len(x)), self.feature.shape[1]
        for feature, edge, leaf in zip(self.feature, self.edge, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:  # all rows go down one level at a time
                node = 2 * node + 1 + (x[rows, feature[node]] > edge[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting on histograms of BINS quantile bins."""
    inner = 2**DEPTH - 1
    features, edges, leaves = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    if not len(y):
        return Trees(0.0, features, edges, leaves)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    flat = binned + np.arange(x.shape[1]) * BINS
    total = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = (((node - first) * x.shape[1] * BINS)[:, None] + flat).ravel()
            sums = [np.bincount(at, np.repeat(v, x.shape[1]), width * x.shape[1] * BINS).reshape(width, x.shape[1], BINS).cumsum(2) for v in (gradient, weight, np.ones(len(y)))]
            (g, h, n), (gt, ht, nt) = sums, [s[:, :, -1:] for s in sums]
            gain = g**2 / (h + SMOOTH) + (gt - g) ** 2 / (ht - h + SMOOTH) - gt**2 / (ht + SMOOTH)
            gain[(n < LEAST) | (nt - n < LEAST)] = -1
            best = gain.reshape(width, -1).argmax(1)
            for j, b in enumerate(best):
                f, k = divmod(int(b), BINS)
                if gain[j, f, k] > 1e-9 and k < len(cuts[f]):
                    features[t, first + j], edges[t, first + j] = f, cuts[f][k]
            node = 2 * node + 1 + (x[np.arange(len(y)), features[t, node]] > edges[t, node])
        g, h = (np.bincount(node - inner, v, inner + 1) for v in (gradient, weight))
        leaves[t] = -RATE * g / (h + SMOOTH)
        total += leaves[t][node - inner]
    return Trees(base, features, edges, leaves)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees learned from at most `sample` labelled documents whose fold is not 0."""
    frugal(docs.sparkSession)
    usable = labels.where((fold("doc_id", FOLDS) != 0) & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("_label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: `sample` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text")).orderBy("doc_id").select(text_statistics("text").alias("x"), "_label").toPandas()
    x = np.stack(rows["x"].to_numpy()).astype(np.float32) if len(rows) else np.zeros((0, N_FEATURES), np.float32)
    return grow(x, rows["_label"].to_numpy(np.float64))


def score(spark: SparkSession, trees: Trees, text: Column) -> Column:
    """The chance of label 1 for whole texts."""
    model = frugal(spark).sparkContext.broadcast(trees)

    @F.pandas_udf(DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            x = np.stack([statistics(t) for t in series]) if len(series) else np.zeros((0, N_FEATURES), np.float32)
            yield pd.Series(model.value.scores(x))

    return scored(text)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out"), score(spark, trees, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
