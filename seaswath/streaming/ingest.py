"""Sonar files as a stream: each new .jsf file is decoded, paired and written as pings while others arrive.

A line is one file, so that a micro-batch holds whole lines and pairing needs no state; files are only named by the
stream and read in byte ranges by many tasks, whatever their size. Batches that are run again after a failure
overwrite what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seaswath.operators import ingest
from seaswath.sources import jsf
from seaswath.types import Params

FILES = "path string, modificationTime timestamp, length long, content binary"


def messages(spark: SparkSession, source: str, files_a_batch: int = 8, mode: str = "PERMISSIVE") -> DataFrame:
    """A stream of messages."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.jsf").option("maxFilesPerTrigger", files_a_batch).load(source)
    if not jsf.known(source):
        return jsf.decoded(files, mode)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return jsf.decoded_ranges(jsf.ranges(files.select("path", "length"), parts), mode)


def start(spark: SparkSession, source: str, out: str, checkpoint: str, p: Params, once: bool = False) -> StreamingQuery:
    """Writes pings below out, in a folder for each batch; `once` takes what is there and ends."""

    def write(batch: DataFrame, number: int) -> None:
        rows = ingest.downsample(ingest.pings(batch, p.frequency), p.slant_range, p.res)
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "line").parquet(out)

    writer = messages(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()
