"""Incremental ingest: messages, raw pings and downsampled pings of sonar files, by line, with a manifest of what was read.

A run lists the files (their names, sizes and times alone), compares them with the manifest, and decodes the lines of which a file is
new or changed, whole: their parts of the three tables are replaced, all others stay. The manifest is a table that only
grows and is written last, so a run that failed is done again by the next one. Files that are gone keep their lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.operators import ingest
from seaswath.operators.ordered import LINE
from seaswath.sources import jsf
from seaswath.sources.tables import dropped, exists, stored, workspace
from seaswath.types import Params

FILE = ["path", "length", "modified"]
MANIFEST = "line string, path string, length long, modified timestamp, run timestamp"


def listed(spark: SparkSession, source: str) -> DataFrame:
    """line, path, length, modified of the sonar files below source; nothing is read of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[jJ][sS][fF]").option("recursiveFileLookup", "true").load(source)
    name = F.regexp_extract("path", r"([^/]*)\.[jJ][sS][fF]$", 1)
    return files.select(name.alias(LINE), "path", "length", F.col("modificationTime").alias("modified"))


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The files as they were last read."""
    path = f"{out}/manifest"
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    last = spark.read.schema(MANIFEST).parquet(path).groupBy("path").agg(F.max_by(F.struct(LINE, "length", "modified", "run"), "run").alias("f"))
    return last.select(f"f.{LINE}", "path", "f.length", "f.modified", "f.run")


def pending(spark: SparkSession, source: str, out: str) -> DataFrame:
    """The files (as of `listed`) of all lines that a new or changed file belongs to."""
    files = listed(spark, source)
    changed = files.join(manifest(spark, out), FILE, "left_anti").select(LINE).distinct()
    return files.join(changed, LINE, "left_semi")


def messages_of(files: DataFrame, source: str, mode: str, split: int) -> DataFrame:
    """All messages of files."""
    spark = files.sparkSession
    if not jsf.known(source):
        content = spark.read.format("binaryFile").option("pathGlobFilter", "*.[jJ][sS][fF]").option("recursiveFileLookup", "true").load(source)
        return jsf.decoded(content.join(files.select("path"), "path", "left_semi"), mode)
    ranges = files.agg(F.sum(F.ceil(F.col("length") / split))).first()[0] or 1
    return jsf.decoded_ranges(jsf.ranges(files, max(int(ranges), 1), split), mode, split)


def replaced(rows: DataFrame, path: str) -> None:
    """Write the lines of rows in the place of what a table has of them."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LINE).parquet(path)


def read(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One of the tables messages, raw and pings."""
    return spark.read.parquet(f"{out}/{name}").withColumn(LINE, F.col(LINE).cast("string"))


def update(spark: SparkSession, source: str, out: str, p: Params, mode: str = "FAILFAST", split: int = jsf.SPLIT) -> int:
    """Bring the tables below out up to date; the number of files that were read."""
    # Written, so that a file that arrives meanwhile waits for the next run.
    folder = workspace(spark)
    files = stored(pending(spark, source, out).select(LINE, *FILE), folder, "files")
    count = files.count()
    if count:
        lines = files.select(LINE).distinct()
        replaced(messages_of(files, source, mode, split), f"{out}/messages")
        # From here on, the stored messages of these lines alone are read.
        acoustic = ingest.acoustic(read(spark, out, "messages"), p.frequency).join(lines, LINE, "left_semi")
        replaced(ingest.pings(acoustic, p.frequency), f"{out}/raw")
        raw = read(spark, out, "raw").join(lines, LINE, "left_semi")
        replaced(ingest.downsample(raw, p.slant_range, p.res), f"{out}/pings")
        files.select(LINE, *FILE, F.current_timestamp().alias("run")).write.mode("append").parquet(f"{out}/manifest")
    dropped(spark, folder, "files")
    return count
