"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share (spark.checkpoint.dir); a temporary one for a local master where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = base or f"file://{tempfile.mkdtemp(prefix='seaswath-')}"
    return f"{base.rstrip('/')}/tiles-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """df written below folder and read again: later stages read it more than once."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def dropped(spark: SparkSession, folder: str, name: str) -> None:
    """Delete a table that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)
