"""8. Toxicity by the nearest labelled examples.

Examples are a bounded sample of labelled documents. All their terms (64-bit hashes of words) are the dimensions; a
term's document frequency is counted over all documents. A vector's weights are (1 + log tf) * idf * relevance: the
relevance is 1 for most terms, and more for those that tell the label in the sample (by likelihood ratio), without
which the nearest examples are those of the same subject. Examples are stored as an inverted index whose postings lie
in blocks of BLOCK examples, with each term's largest weight in each block. A document's cosine with all examples of
a block is at most the sum of its weights times those maxima: the blocks of the highest bounds are scored from their
postings, then all others whose bound reaches the K-th best, so that the K nearest are exact.

A document's vote is the cosine-weighted share of toxic examples among its K nearest, and their weight as such; a
logistic fit of votes of the examples themselves (each left out of its own vote), in which each label weighs as much
as it has among all labelled rows, turns it into a chance. Evidence: the nearest example's id and cosine.

Null and empty texts, and texts with no term of any example, have no neighbour and get the base chance of such
documents. Null labels are not learned from; a doc_id labelled twice counts with the smaller label, and one that
repeats among documents with its least text. Ties go to the smaller doc_id. Repeated rows get equal results; no labels
at all give score 0. A null doc_id is not held out. Only doc_id, text and the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm.common import fold, frugal, slices, table, texts_of
from seaswath.llm.words import hashed_words

PER_LABEL, K, BLOCK, FIRST_BLOCKS, FOLDS, THRESHOLD = 2000, 12, 32, 4, 5, 0.5
#: Twice the log-likelihood ratio from which on a term tells the label, and what each unit beyond adds to its relevance.
LIKELIHOOD, ADDED = 10.0, 0.1


def runs_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i], ..., starts[i] + lengths[i] - 1 of all i, one run after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def bags(texts: list[str], terms: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the distinct terms of every text, sorted; with `terms` (sorted), the terms' places among these alone."""
    hashes, ends, _, _ = hashed_words(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(ends))
    if terms is None:
        order = np.lexsort((hashes, text))
        text, found = text[order], hashes[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(text)), bool), (text[1:] != text[:-1]) | (found[1:] != found[:-1])]))
        return text[new], found[new], np.diff(np.append(new, len(text)))
    if not len(terms):
        return text[:0], text[:0], text[:0]
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    known = terms[place] == hashes
    both, count = np.unique(text[known] * len(terms) + place[known], return_counts=True)
    return both // len(terms), both % len(terms), count


class Index:
    """Block-max inverted index of unit vectors of labelled examples, given as (example, term's place, count)."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, terms: np.ndarray, example: np.ndarray, place: np.ndarray, count: np.ndarray, idf: np.ndarray, relevance: np.ndarray):
        self.terms, self.scale, self.slope = terms, idf * relevance, np.array([0.0, 8.0, 0.0])
        weight = self._weights(example, place, count, len(ids))
        # Examples whose heaviest terms are the same lie in the same blocks, so that few blocks have high bounds.
        heaviest = np.full(len(ids), len(terms))
        order = np.lexsort((weight, example))
        heaviest[example[order]] = place[order]
        seat = np.empty(len(ids), np.int64)
        seat[np.lexsort((ids, heaviest))] = np.arange(len(ids))
        self.ids, self.toxic = np.empty(len(ids), np.int64), np.empty(len(ids))
        self.ids[seat], self.toxic[seat] = ids, toxic
        self.seat, self.blocks = seat, max(1, -(-len(ids) // BLOCK))
        # Postings by term, then example; entries are the runs of a term's postings in one block.
        order = np.lexsort((seat[example], place))
        self.example, self.weight, place = seat[example[order]].astype(np.int32), weight[order], place[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(place)), bool), (place[1:] != place[:-1]) | (self.example[1:] // BLOCK != self.example[:-1] // BLOCK)]))
        self.begin, self.length = new, np.diff(np.append(new, len(place)))
        self.block, self.most = self.example[new] // BLOCK, np.maximum.reduceat(self.weight, new) if len(new) else self.weight
        self.entries = np.searchsorted(place[new], np.arange(len(terms) + 1))

    def _weights(self, text: np.ndarray, place: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        w = (1 + np.log(count)) * self.scale[place]
        return w / np.sqrt(np.maximum(np.bincount(text, w * w, n), 1e-300))[text]

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and weights of each text's unit vector."""
        text, place, count = bags(texts, self.terms)
        weight = self._weights(text, place, count, len(texts))
        cut = np.searchsorted(text, np.arange(1, len(texts)))
        return list(zip(np.split(place, cut), np.split(weight, cut), strict=True)) if texts else []

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Exact: places and cosines of the k nearest examples with any term in common."""
        many = self.entries[at + 1] - self.entries[at]
        entry, mine = runs_of(self.entries[at], many), np.repeat(w, many)
        block = self.block[entry]
        bound = np.bincount(block, mine * self.most[entry], self.blocks)
        scores, todo = np.zeros(len(self.ids)), np.zeros(self.blocks, bool)
        todo[np.argpartition(-bound, min(FIRST_BLOCKS, self.blocks) - 1)[:FIRST_BLOCKS]] = True
        done = np.zeros(self.blocks, bool)
        for _ in range(2):
            on = todo[block]
            length = self.length[entry[on]]
            post = runs_of(self.begin[entry[on]], length)
            scores += np.bincount(self.example[post], np.repeat(mine[on], length) * self.weight[post], len(self.ids))
            if without >= 0:
                scores[without] = 0
            done |= todo
            kth = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else 0.0
            todo = ~done & (bound > 0) & (bound >= kth - 1e-12)
            if not todo.any():
                break
        best = np.flatnonzero(scores > 0) if len(scores) <= k else np.flatnonzero(scores >= max(kth - 1e-12, 1e-300))
        best = best[np.lexsort((self.ids[best], -np.round(scores[best], 12)))][:k]
        return best, scores[best]

    def votes(self, at: np.ndarray, w: np.ndarray, without: int = -1) -> tuple[np.ndarray, int, float]:
        """(1, share of toxic weight, toxic weight), and the nearest example."""
        best, cosines = self.nearest(at, w, without=without)
        if not len(best):
            return np.array([1.0, 0.0, 0.0]), -1, 0.0
        weight = cosines**2
        mine = float(weight @ self.toxic[best])
        return np.array([1.0, mine / weight.sum(), mine / K]), int(best[0]), float(cosines[0])

    def calibrate(self, votes: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic fit by Newton steps with a small ridge; rows in the order of the index's examples."""
        w = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(votes @ w, -30, 30)))
            h = (votes * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ votes + 1e-1 * np.eye(3)
            w -= np.linalg.solve(h, votes.T @ (weight * (p - self.toxic)) + 1e-1 * w)
        self.slope = w

    def chance(self, votes: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(votes @ self.slope, -30, 30)))) if len(self.ids) else 0.0


def relevances(place: np.ndarray, toxic: np.ndarray, n_terms: int, n: int, n_toxic: int) -> np.ndarray:
    """1, and ADDED for each unit that a term's likelihood ratio with the label exceeds LIKELIHOOD by; a row for each term of each example."""
    df, with_toxic = np.bincount(place, minlength=n_terms), np.bincount(place, toxic, n_terms)
    expected = df * n_toxic / max(1, n)
    part = lambda seen, expected: seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300))
    return 1 + ADDED * np.maximum(2 * (part(with_toxic, expected) + part(df - with_toxic, df - expected)) - LIKELIHOOD, 0)


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """Over all documents: how many hold each of the (sample-bounded) terms, and how many documents there are."""
    wanted = frugal(docs.sparkSession).sparkContext.broadcast(terms)

    def run(batches):
        df, n = np.zeros(len(wanted.value), np.int64), 0
        for batch in slices(batches, "text"):
            df += np.bincount(bags(texts_of(batch), wanted.value)[1], minlength=len(df))
            n += batch.num_rows
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(df[held], n))], ["place", "df"])

    rows = docs.select("text").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).toArrow()  # bounded: a row for each term
    place, df = (rows.column(c).to_numpy() for c in ("place", "df"))
    out = np.zeros(len(terms), np.int64)
    out[place[place >= 0]] = df[place >= 0]
    return out, int(df[place < 0].sum())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL) -> Index:
    """An index of at most per_label examples of each label, those of the lowest hashes, outside fold 0."""
    usable = labels.where((fold("doc_id", FOLDS) != 0) & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("_label"))
    pick = [usable.where(F.col("_label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    chosen = pick[0].unionByName(pick[1])
    counts = dict(usable.groupBy("_label").count().collect())
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text"))

    def bagged(batches):
        for batch in slices(batches, "text"):
            text, term, count = bags(texts_of(batch))
            ends = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (term.view(np.int64), count)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("_label"), *lists], ["doc_id", "_label", "terms", "counts"])

    got = rows.select("doc_id", "_label", "text").mapInArrow(bagged, "doc_id long, _label int, terms array<long>, counts array<long>").toArrow().combine_chunks().sort_by("doc_id")
    ids, toxic = got.column("doc_id").to_numpy(), got.column("_label").to_numpy().astype(np.float64)
    lists = got.column("terms").combine_chunks()
    held, count = (got.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
    example = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy().astype(np.int64))
    terms, place = np.unique(held.view(np.uint64), return_inverse=True)
    df, n = document_frequencies(docs, terms)
    index = Index(ids, toxic, terms, example, place, count, np.log((1 + n) / (1 + df)) + 1, relevances(place, toxic[example], len(terms), len(ids), int(toxic.sum())))
    if len(ids):
        votes, weight = np.zeros((len(ids), 3)), np.zeros(len(ids))
        cut = np.searchsorted(example, np.arange(1, len(ids)))
        weights = index._weights(example, place, count, len(ids))
        shares = {y: counts.get(y, 0) / max(1, (toxic == y).sum()) * len(ids) / max(1, sum(counts.values())) for y in (0, 1)}
        for i, (at, w) in enumerate(zip(np.split(place, cut), np.split(weights, cut), strict=True)):
            votes[index.seat[i]], weight[index.seat[i]] = index.votes(at, w, int(index.seat[i]))[0], shares[int(toxic[i])]
        index.calibrate(votes, weight)
    return index


def judge(spark: SparkSession, index: Index, text: Column) -> Column:
    """struct(score, example, cosine) of whole texts."""
    model = frugal(spark).sparkContext.broadcast(index)

    @F.pandas_udf("score double, example long, cosine double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            own, out = model.value, []
            for part in slices(iter([pa.RecordBatch.from_arrays([pa.array(series, pa.string())], ["text"])]), "text"):
                for at, w in own.vectors(texts_of(part)):
                    votes, example, cosine = own.votes(at, w)
                    out.append((own.chance(votes), int(own.ids[example]) if example >= 0 else None, cosine))
            yield pd.DataFrame({"score": [r[0] for r in out], "example": pd.array([r[1] for r in out], "Int64"), "cosine": [r[2] for r in out]})

    return judged(text)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out")
    found = docs.select("doc_id", held_out, judge(spark, index, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.score", (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"), "found.example", "found.cosine")
