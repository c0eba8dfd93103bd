"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seaswath.llm.bpe import op1_bpe
from seaswath.llm.centroids import op12_centroids
from seaswath.llm.divergence import op13_divergence
from seaswath.llm.language import op3_language
from seaswath.llm.near_dedup import op7_near_dedup
from seaswath.llm.neighbours import op5_neighbours
from seaswath.llm.packing import op4_packing
from seaswath.llm.pieces import op11_sentencepiece
from seaswath.llm.quality import op2_quality
from seaswath.llm.sql import SQL
from seaswath.llm.substring_dedup import op10_substring_dedup
from seaswath.llm.token_file import op6_token_file
from seaswath.llm.toxicity import op8_toxicity
from seaswath.llm.vector_dedup import op9_vector_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_language": op3_language,
        "op4_packing": op4_packing,
        "op5_neighbours": op5_neighbours,
        "op6_token_file": op6_token_file,
        "op7_near_dedup": op7_near_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_vector_dedup": op9_vector_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_centroids": op12_centroids,
        "op13_divergence": op13_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
