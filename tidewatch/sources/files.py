"""File sources: drop folders (XML metadata + capture files), rotated log files.

Covers SRC-08, SRC-09, SRC-10, SRC-11, SRC-12 on real files.  Every reader is a Spark
data source (``binaryFile``, ``text``) so listing and reading are distributed; capture
files are only listed (column pruning keeps ``content`` unread).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES -- rotated log segment name: app.log-YYYYMMDD
ROTATED_LOG_RE = r"app\.log-(\d{8})$"


def local_path(path: F.Column) -> F.Column:
    """One spelling for file URIs (``file:/x`` and ``file:///x`` -> ``/x``) so paths from
    different readers can be joined."""
    return F.regexp_replace(path, r"^file:/+", "/")


def drop_folder_listing(spark: SparkSession, root: str, min_age_seconds: int = 20,
                        now: F.Column | None = None, glob: str | None = None) -> DataFrame:
    """SRC-10: every file under ``root`` (recursively) untouched for more than
    ``min_age_seconds``; a streaming read of the same source remembers files it has seen."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root).select(local_path(F.col("path")).alias("path"), "modificationTime", "length")
    now = now if now is not None else F.current_timestamp()
    return df.filter(F.col("modificationTime") < now - F.expr(f"INTERVAL {int(min_age_seconds)} SECONDS"))


def xml_files(spark: SparkSession, root: str) -> DataFrame:
    """SRC-11 input: one row per XML metadata file (small files; ``wholetext`` keeps a
    file's elements together)."""
    t = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.xml").text(root))
    return t.select(local_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content"))


def capture_files(spark: SparkSession, root: str) -> DataFrame:
    """SRC-12: capture files as (path) only -- the content column is pruned away."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.pcap").load(root)
            .select(local_path(F.col("path")).alias("path"), "modificationTime"))


def log_lines(spark: SparkSession, root: str) -> DataFrame:
    """SRC-08 backfill: every line of every log segment with the segment it came from."""
    t = spark.read.option("recursiveFileLookup", "true").text(root)
    return t.select(local_path(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("line"))


def newest_segment(lines: DataFrame) -> DataFrame:
    """SRC-09 / SORT-03: lines of the newest rotated segment (``app.log-YYYYMMDD``, latest
    date wins); ``max`` of the date is a single aggregate, the lines stay distributed."""
    seg = lines.withColumn("seg_date", F.regexp_extract("file", ROTATED_LOG_RE, 1)).filter(F.col("seg_date") != "")
    newest = seg.agg(F.max("seg_date").alias("seg_date"))
    return seg.join(newest, "seg_date", "left_semi")
