"""Shared helpers: the shared work folder, written intermediates, connected components."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application, whatever their
    working folder is.  The archive is a file of the driver that Spark itself distributes.  Arrow
    batches get a bound that suits whole texts unless the session has set its own."""
    # rows are whole texts; Spark's default batch of 64 MB, on both sides of every task, is a lot
    if spark.conf.get(BATCH_BYTES, None) in (None, "67108864b", "64m"):
        spark.conf.set(BATCH_BYTES, "8m")
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        out = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidewatch-")), "tidewatch_package")
        context.addPyFile(shutil.make_archive(out, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def release() -> None:
    """Give freed memory back to the system.  A Python worker lives through many tasks and keeps what the
    largest of them took, and an executor's memory is that of all its workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, between two releases of memory."""
    def leaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(batches)
        release()
    return leaned


def work_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    A local session that names none gets a folder below the system's temporary one; a cluster
    must name it, because its machines don't share their temporary folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tidewatch-work")


def stored(df: DataFrame, name: str) -> str:
    """The new folder in the shared one that has ``df`` as Parquet."""
    spark = df.sparkSession
    path = f"{work_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later readers don't
    compute it again, and no executor's loss can take it away."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, name))


SIEVE_BITS = 26   # a sieve is 8 MB at most, whatever the tables' size


def sifted(rows: DataFrame, of: F.Column, side: DataFrame, side_of: F.Column) -> DataFrame:
    """``rows`` and a boolean ``_near``: false only where no row of ``side`` has the same hash (``of`` and
    ``side_of`` are 64-bit hashes of what a join compares).  Wide rows that are not near needn't be shuffled
    for that join.  The sieve is a bitmap of fixed size in pieces of 32,768 bits, so more of ``side`` lets more
    rows pass as near, and none is lost."""
    place = lambda h: F.pmod(h, F.lit(1 << SIEVE_BITS))
    pieces = (side.select(place(side_of).alias("_at")).groupBy(F.shiftright("_at", 15).alias("_piece"))
              .agg(F.bitmap_construct_agg(F.col("_at").bitwiseAND(32767)).alias("_bits")))
    at = F.col("_at").bitwiseAND(32767)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1, F.lit(False))
    wide = rows.withColumn("_at", place(of))
    return (wide.join(F.broadcast(pieces), F.shiftright("_at", 15) == F.col("_piece"), "left")
            .select(*rows.columns, near.alias("_near")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: one row (node, component_id) for each node
    that has an edge to another one; component_id is the component's smallest node.

    Alternates two star steps until nothing changes (a logarithmic number of rounds also for
    long chains).  Every step is a grouped minimum, combined before the shuffle, and a join; no
    node's neighbours are ever gathered in one place.  Each round is written to the shared folder.
    Null ends and loops are ignored; repeated edges change nothing.
    """
    e = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    e = written(e, "edges")
    before = _state(e)
    while before[0]:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = written(small, "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return (e.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("component_id"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()))
