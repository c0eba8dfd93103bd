"""4. Packing along a space-filling curve.

Each document's byte trigrams are hashed into a vector, projected to three dimensions and turned into a
Hilbert key; documents are range-sorted by that key, and the ids of neighbours along the curve run on
from sequence to sequence. Each partition's last ids go into sequences of the powers of two they sum to,
so that nothing is padded.

Null text counts as empty: the end id alone. A key that very many documents share (copies) is dealt over
partitions by doc_id. Repeated rows are packed each. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seaswath.llm.common import frugal, n_parts, slices, table, texts_of
from seaswath.llm.tokens import default_path, encoder, little_endian

LENGTH, END_ID = 1024, 0
HASHED, DIMENSIONS, BITS, SEED = 2048, 3, 20, 11
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def vectors(texts: list[str]) -> np.ndarray:
    """Unit vectors of hashed byte trigrams, projected to a few dimensions."""
    plane = np.random.default_rng(SEED).standard_normal((HASHED, DIMENSIONS)).astype(np.float32)
    hashed = np.zeros((len(texts), HASHED), np.float32)
    for i, text in enumerate(texts):
        b = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
        if len(b) > 2:
            code = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
            hashed[i] = np.sqrt(np.bincount(code >> 21, minlength=HASHED))
    norms = np.linalg.norm(hashed, axis=1, keepdims=True)
    return (hashed / np.maximum(norms, 1e-9)) @ plane


def hilbert_keys(points: np.ndarray, low: float = -4.0, high: float = 4.0) -> np.ndarray:
    """Position along the Hilbert curve through a grid of 2**BITS steps a dimension."""
    top = (1 << BITS) - 1
    x = np.clip((points - low) / (high - low) * top, 0, top).astype(np.int64).T.copy()
    q = 1 << (BITS - 1)
    while q > 1:  # undo the rotations, from the coarsest cell to the finest
        p = q - 1
        for i in range(len(x)):
            inside = (x[i] & q) > 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(inside, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (BITS - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for row in x:
            key = (key << 1) | ((row >> bit) & 1)
    return key


@F.pandas_udf(LongType())
def curve_key(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in texts:
        keys = [hilbert_keys(vectors([t or "" for t in series.iloc[i : i + 256]])) for i in range(0, len(series), 256)]
        yield pd.Series(np.concatenate(keys) if keys else np.zeros(0, np.int64))


class Packer:
    """Cuts a run of documents into pieces of sequences; numbers sequences from a first one."""

    def __init__(self, first: int, length: int):
        self.sequence, self.length, self.open, self.filled = first, length, [], 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(self.length - self.filled, len(ids) - start)
            self.open.append((doc_id, start, ids[start : start + take], len(ids)))
            self.filled += take
            start += take
            if self.filled == self.length:
                yield from self._close(self.open)
                self.open, self.filled = [], 0

    def finish(self) -> Iterator[tuple]:
        """What is left, in sequences of powers of two."""
        left, self.open = self.open[::-1], []
        while self.filled:
            room = 1 << (self.filled.bit_length() - 1)
            self.filled -= room
            now = []
            while room:
                doc_id, start, ids, total = left.pop()
                now.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    left.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            yield from self._close(now)

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), zlib.crc32(little_endian(ids)), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    path = path or default_path()
    frugal(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc, packer = encoder(path), Packer(TaskContext.get().partitionId() << 40, length)
        tail = np.array([end_id], np.uint32)
        types = pa.schema([pa.field(c, pa.int64()) for c in COLUMNS])
        made = lambda rows, ids: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], ids), *(pa.array([r[i] for r in rows], types[i].type) for i in range(1, 7))], COLUMNS)
        ids_type = pa.int64()
        for batch in slices(batches, "text"):
            ids_type = batch.column(0).type
            rows = [p for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True) for p in packer.add(doc_id, np.concatenate([enc.encode(text), tail]))]
            yield made(rows, ids_type)
        yield made(list(packer.finish()), ids_type)

    keyed = docs.select("doc_id", "text", curve_key("text").alias("curve"))
    along = keyed.repartitionByRange(n_parts(docs), "curve", "doc_id", F.xxhash64("text")).sortWithinPartitions("curve", "doc_id", F.xxhash64("text"))
    return along.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
