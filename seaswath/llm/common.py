"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read by Spark (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='seaswath-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, one of our own for a local master; a cluster must set it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or _own_dir()).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes that an Arrow batch may hold on its way to a Python worker.
BATCH_BYTES = 4 << 20


def frugal(spark: SparkSession) -> SparkSession:
    """The session with its Arrow batches bounded by bytes, not by rows alone: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = frugal(df.sparkSession)
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Delete a table made by `written` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def one_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key (long), text: one row for each key that is not null; a key that repeats stands with its least text, null last.

    Keys alone are counted first: only rows of keys that repeat are shuffled with their texts.
    """
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), text)
    again = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "repeated-keys")
    if not again.limit(1).count():
        return rows
    return rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").groupBy(key).agg(F.min(text).alias(text)))


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 512, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds few rows and a bounded number of bytes of a string column (one row at least)."""
    for batch in batches:
        lengths = [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()]
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= rows or total + n > size):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(lengths) > start:
            yield batch.slice(start)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def fold(key: str, folds: int):
    """crc32 of a key written as text, modulo folds: the split of labelled rows."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


#: Bytes of text that a partition of documents should hold.
PART_BYTES = 256 << 20


def n_parts(docs: DataFrame, text: str = "text") -> int:
    """Partitions for a shuffle of documents: the session's number, or more where these would hold over PART_BYTES of text each."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
