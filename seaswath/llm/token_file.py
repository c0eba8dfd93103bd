"""6. Token ids as ORC: stripes with integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are range-sorted by id, so that each file and stripe holds a run of ids: the statistics of
stripes and row groups prune a range of ids, the Bloom filters a single id. Files hold for each document
its partition and its offset there; a document's global start is that plus the ids of all partitions
before, sums of one row for each partition.

Null text counts as empty (the end id alone). Null ids sort first; repeated ids are stored each, in the
order of their texts' hashes, which also deals one id that very many rows share over several partitions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seaswath.llm.common import frugal, n_parts, shared_path, slices, table, texts_of
from seaswath.llm.tokens import default_path, encoder

END_ID = 2
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "compression": "zstd"}


def write_ids(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode every whole text, append end_id, write ORC files under out in ascending doc_id order."""
    path = path or default_path()
    frugal(docs.sparkSession)

    def run(batches):
        enc, part, done = encoder(path), TaskContext.get().partitionId(), 0
        tail = np.array([end_id], np.uint32)
        for batch in slices(batches, "text"):
            ids = [x for t in texts_of(batch) for x in (enc.encode(t), tail)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)).reshape(-1, 2).sum(1)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            values = pa.array(np.concatenate(ids).astype(np.int32))
            columns = [batch.column(0), pa.array(np.full(len(lengths), part, np.int32)), pa.array(done + ends[:-1]), pa.array(lengths), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "part_start", "n_tokens", "ids"])
            done += int(ends[-1])

    key = docs.schema["doc_id"].dataType.simpleString()
    ranged = docs.select("doc_id", "text").repartitionByRange(n_parts(docs), "doc_id", F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, f"doc_id {key}, part int, part_start long, n_tokens long, ids array<int>").write.options(**ORC).orc(out)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document; ORC readers split files by stripes and prune by doc_id."""
    rows = spark.read.orc(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each written partition: its size does not grow with the documents but with their partitions.
    base = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The stored row of one document: stripes are skipped by statistics and Bloom filters."""
    return read_ids(spark, path).where(F.col("doc_id") == doc_id)


def with_crc(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: the digest of all ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            raw = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.mapInArrow(run, f"doc_id {stored.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "ids-orc")
    write_ids(table(spark, sf_dir, "documents"), out)
    return with_crc(read_ids(spark, out))
