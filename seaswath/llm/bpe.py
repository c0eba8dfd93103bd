"""1. BPE encoding and decoding by distinct-word tables.

Spark splits each text into words (the tokenizer's own pre-tokens); each block of documents builds the
table of its distinct words, encodes each of them once, and joins the ids back to every position through
the table. Decoding joins ids to their pieces (the vocabulary: a table of fixed size) and concatenates.
The table is per block (one Arrow batch of documents), so that no word occurrence is ever shuffled.

Null and empty texts have no ids. Texts with a special token's string, or with a character that the JVM's Unicode
tables do not know (the only ones on whose class engines disagree), count as a single word, which the tokenizers
library encodes whole. Of a worker's words only those of at most LONGEST characters are remembered, REMEMBERED at most.
Only the key and the text are read: further columns cannot clash. Repeated rows give repeated results; a very long
text is one row of its own block. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm.common import frugal, table
from seaswath.llm.tokens import Encoder, default_path, encoder

#: The pre-tokenizer's pattern for Java's engine: fixed values.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_AT_ONCE = 1_500_000
REMEMBERED, LONGEST = 300_000, 64


def words_of(text: Column, special: list[str]) -> Column:
    """The words of a text, in order, as an array; a text that needs the library whole is one word."""
    whole = text.rlike(r"\p{Cn}")
    for s in special:
        whole = whole | F.contains(text, F.lit(s))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).when(whole, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit("(?U)" + SPLIT), F.lit(0)))


class _Remembered(dict):
    """Ids of words already encoded in this worker; emptied when full, so bounded."""

    def __init__(self, enc: Encoder):
        self.enc = enc

    def __missing__(self, word: str) -> np.ndarray:
        ids = self.enc.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def _memory(path: str) -> _Remembered:
    return _Remembered(encoder(path))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[starts[r]:starts[r]+lengths[r]] of all rows one after another, and where each begins (and the last ends)."""
    n = lengths[rows]
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(starts[rows] - ends[:-1], n) + np.arange(ends[-1])
    return flat[at], ends


def encode_words(words: pa.Array, memory: _Remembered) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in order, and where each word's ids begin: each distinct word is encoded once."""
    coded = words.dictionary_encode()
    ids = [memory[w] for w in coded.dictionary.to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    starts = np.cumsum(lengths) - lengths
    return gather(np.concatenate([np.zeros(0, np.uint32), *ids]), starts, lengths, coded.indices.to_numpy(zero_copy_only=False))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """Rows with the ends of their words, and the words; cut by documents where a batch holds very many words."""
    for batch in batches:
        lists = batch.column("words")
        ends, start = lists.offsets.to_numpy(), 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + WORDS_AT_ONCE, "right")) - 1)
            yield batch.slice(start, stop - start), ends[start : stop + 1] - ends[start], lists.values.slice(ends[start], ends[stop] - ends[start])
            start = stop


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int): the ids of every whole text."""
    path = path or default_path()

    def run(batches):
        memory = _memory(path)
        for rows, ends, words in _blocks(batches):
            ids, at = encode_words(words, memory)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(at[ends].astype(np.int32)), pa.array(ids.astype(np.int32)))], [key, "ids"])

    frugal(docs.sparkSession)
    split = docs.select(F.col(key), words_of(F.col(text), list(encoder(path).special)).alias("words"))
    return split.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


@lru_cache(maxsize=2)
def _piece_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pieces = encoder(path).pieces
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths, lengths


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: each row's ids joined to their pieces; null ids count as none."""
    path = path or default_path()

    def run(batches):
        for batch in batches:
            out, lists = [], batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum([n or 0 for n in lists.value_lengths().to_pylist()])]).astype(np.int64)
            for a, b in zip(ends, ends[1:], strict=False):
                got, _ = gather(*_piece_table(path), flat[a:b])
                out.append(got.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, of which only digests leave the task."""
    path = path or default_path()

    def run(batches):
        memory = _memory(path)
        for rows, ends, words in _blocks(batches):
            ids, at = encode_words(words, memory)
            at = at[ends]
            raw, ends_of = ids.astype("<u4").tobytes(), at.tolist()
            codes = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(ends_of, ends_of[1:], strict=False)]
            decoded = []
            for a, b in zip(ends_of, ends_of[1:], strict=False):
                got, _ = gather(*_piece_table(path), ids[a:b])
                decoded.append(hashlib.sha256(got.tobytes().decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), pa.array(codes, pa.string()), pa.array(decoded, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    frugal(docs.sparkSession)
    split = docs.select(F.col(key), words_of(F.col(text), list(encoder(path).special)).alias("words"))
    return split.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
