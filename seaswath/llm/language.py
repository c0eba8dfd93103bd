"""3. Language identification by string kernels.

Two texts' kernel is the number of character n-grams (bytes of the lower-cased text, n from 1 to 4,
hashed) that both contain, over the root of the product of their numbers of n-grams: presence, not
counts. Nystrom features come from LANDMARKS sampled documents; one-versus-rest kernel ridge regression
on them is fitted to a bounded sample. Since the kernel is linear in presence vectors, landmarks and
coefficients multiply out to one matrix (hashed n-grams x languages), and a batch of documents is scored
by one product with it: the same scores, without a column for each landmark.

Null texts and texts without a letter are `und` with score 0, and so is everything where no labelled
text exists. Ties go to the language first in alphabetical order. Repeated rows get equal results. A null doc_id is
neither learned from nor held out. In very long texts most hashed n-grams are present, so that scores (not the order
of languages) fall. Only doc_id, text and lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm.common import fold, frugal, slices, table, texts_of

PER_LANGUAGE, SAMPLE, LANDMARKS, FOLDS, HELD_OUT = 1000, 16_000, 256, 3, 1
GRAMS, HASHED_BITS, RIDGE, SHARPNESS, UNKNOWN = (1, 2, 3, 4), 15, 1e-3, 6.0, "und"
LETTER = re.compile(r"[^\W\d_]")
#: Odd multipliers of the n-gram hash, one for each place.
MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def presence(texts: list[str]) -> np.ndarray:
    """A row for each whole text: which hashed n-grams it contains."""
    out = np.zeros((len(texts), 1 << HASHED_BITS), np.uint8)
    for row, text in zip(out, texts, strict=True):
        b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
        for n in GRAMS:
            if len(b) >= n:
                code = np.full(len(b) - n + 1, n * 0x2545F491 & 0xFFFFFFFF, np.uint32)
                for place in range(n):
                    code += b[place : len(b) - n + 1 + place] * np.uint32(MIX[place])
                code ^= code >> np.uint32(15)
                row[(code * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - HASHED_BITS)] = 1
    return out


def normed(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    return x


@dataclass
class Kernel:
    languages: list[str]
    weights: np.ndarray  # hashed n-grams x languages: landmarks times their coefficients

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for i in range(0, len(texts), 128):
            part = texts[i : i + 128]
            if self.languages:
                margins = SHARPNESS * (normed(presence(part)) @ self.weights)
                best = margins.argmax(1)
                chance = np.exp(margins - margins.max(1, keepdims=True))
                scores[i : i + len(part)] = 1 / chance.sum(1)
            for j, text in enumerate(part):
                known = bool(self.languages) and LETTER.search(text) is not None
                names.append(self.languages[best[j]] if known else UNKNOWN)
                scores[i + j] *= known
        return names, scores


def fit(rows: np.ndarray, langs: list[str], landmarks: int = LANDMARKS) -> Kernel:
    """One-versus-rest kernel ridge regression on Nystrom features, of rows of presence as packed bits."""
    presence_of = lambda at: normed(np.unpackbits(rows[at], axis=1))
    languages = sorted(set(langs))
    if not languages:
        return Kernel([], np.zeros((1 << HASHED_BITS, 0), np.float32))
    order = np.random.default_rng(5).permutation(len(rows))[:landmarks]
    marks = presence_of(order)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    phi = np.concatenate([(presence_of(slice(i, i + 128)) @ marks.T).astype(np.float64) @ root for i in range(0, len(rows), 128)])
    target = np.where(np.array(langs)[:, None] == np.array(languages), 1.0, -1.0)
    weight = 1 / (len(languages) * np.unique(langs, return_counts=True)[1][np.searchsorted(languages, langs)])[:, None]  # languages count alike
    beta = np.linalg.solve(phi.T @ (weight * phi) + RIDGE / len(languages) * np.eye(phi.shape[1]), phi.T @ (weight * target))
    return Kernel(languages, (marks.T @ (root @ beta)).astype(np.float32))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Kernel:
    """Learns from about `per_language` documents (those of the lowest hashes) of each language, or fewer where `sample`
    documents in all would not do: every language keeps its share. The driver gets their presence bits, not their texts."""
    usable = docs.where((fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "_lang")
    each = max(1, min(per_language, sample // max(1, counts.count())))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    wanted = usable.join(F.broadcast(counts), F.col("lang") == F.col("_lang")).where(place * F.col("n") < each)

    def present(batches):
        for batch in slices(batches, "text"):
            bits = np.packbits(presence(texts_of(batch)), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("lang"), pa.array([r.tobytes() for r in bits], pa.binary())], ["doc_id", "lang", "bits"])

    got = wanted.select("doc_id", "lang", "text").mapInArrow(present, "doc_id long, lang string, bits binary").orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "bits").limit(2 * sample).toArrow()
    rows = np.frombuffer(b"".join(got.column("bits").to_pylist()), np.uint8).reshape(-1, (1 << HASHED_BITS) // 8)
    return fit(rows, got.column("lang").to_pylist())


def identify(spark: SparkSession, kernel: Kernel, text: Column) -> Column:
    """struct(lang_pred, score) of whole texts."""
    model = frugal(spark).sparkContext.broadcast(kernel)

    @F.pandas_udf("lang_pred string, score double")
    def identified(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            names, scores = model.value.predict([t or "" for t in series])
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return identified(text)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), identify(spark, train(docs), F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
