"""The corpus pipeline: quality, language, near-duplicates, repeated passages, packing.

Counted as part of the subpackage seaswath.llm, whose operators the stages call. Each stage takes
(spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. Null, empty and repeated rows are treated as each operator's docstring says; further columns are
carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm import language, near_dedup, packing, quality, substring_dedup
from seaswath.llm.common import discarded, table, unused, written

#: Below this share the most likely language is no better than a guess.
LEAST_LANGUAGE_SCORE = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trees, learned from the labelled ones among docs, do not reject."""
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(spark, trees, F.col("text")) >= quality.THRESHOLD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those without a letter, or of no clear language, go."""
    name = unused(docs, "found")
    found = docs.withColumn(name, language.identify(spark, language.train(docs), F.col("text")))
    known = (F.col(f"{name}.lang_pred") != language.UNKNOWN) & (F.col(f"{name}.score") >= LEAST_LANGUAGE_SCORE)
    return found.where(known).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the smallest id) of each group of near-duplicates."""
    return near_dedup.deduplicated(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut."""
    return substring_dedup.deduplicated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("packing", packed),
]
#: Trained models, signatures and alignments are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            discarded(before)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
