"""N-gram Jaccard join: texts whose sets of five-word shingles have a similarity of at least 80 %.

Method: prefixes with token combinations.  All shingles have one total order, by how often they
occur; those of high counts are called frequent.  A text of n shingles posts

* each shingle that is not frequent among its first n - ceil(0.8 n) + 1 as a single signature, and
* if one of these is frequent, combinations of two: its prefix is extended by C more shingles, the
  frequent ones in it fall into C classes by hash, and every two of a class are one signature.  C
  is about 1/50 of the size of the larger text (a power of two; a text near the next power posts for both).

Two similar texts share a shingle in their prefixes.  If their first common one is not frequent, they
share its signature.  Else all their common ones are frequent, the extended prefixes share C + 1 of
them, and two of these are in one class.  Hence no link is lost, whatever the counts.

A signature carries an upper bound of the overlap of two texts that first meet there: behind a
single one at place i at most n - i shingles are common, and up to C more for a combination.  Pairs whose
bounds are too low for their sizes are never formed: texts that have only a passage in common are
ruled out by what stands before it in the order.

Counts of shingles are kept by hash in a table of fixed size, summed over all texts; it decides the
order and so only the cost.  ``linking`` verifies exactly and finds the components.

Null or empty texts and texts without words have an empty set and no link.  Equal sets are one node
of the join.  Rows with the same key are documents of their own, with a common component only if
their texts are linked; a null key gets no component unless a linked row has a key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import lean, sifted, stored, written
from .linking import SHINGLE, SIMILAR, link, packed, set_id, shingle_sets
from .textbytes import U64, mix

#: Counters for shingles (16 MB in each Python worker) and the blocks that they are summed in.
COUNTERS = 1 << 22
BLOCK = 1 << 16


def _pack(counts: np.ndarray) -> bytes:
    """Counters by the bytes of their numbers: most are small, so nearly all that is left is their lowest byte."""
    return zlib.compress(np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _measured(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, id, n) of each row, and one row (null key, block number, counts) for each block of counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind, held, waiting = np.zeros(COUNTERS, np.uint32), None, [], 0

        def count() -> None:
            nonlocal waiting
            if held:
                at, times = np.unique(np.concatenate(held), return_counts=True)
                counts[at] += times.astype(np.uint32)
            held.clear()
            waiting = 0

        for batch in batches:
            kind = batch.column(0).type
            for row, h, offsets in shingle_sets(batch.column(1), size):
                held.append((h & U64(COUNTERS - 1)).astype(np.uint32))
                waiting += len(h)
                if waiting > COUNTERS // 4:
                    count()
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(set_id(h, offsets)), pa.array(np.diff(offsets), pa.int64()), pa.nulls(n, pa.binary())],
                    [key, "id", "n", "counts"])
        count()
        if kind is not None and counts.any():
            rows = COUNTERS // BLOCK
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(rows, kind), pa.array(np.arange(rows)), pa.nulls(rows, pa.int64()),
                 pa.array([_pack(counts[k * BLOCK:(k + 1) * BLOCK]) for k in range(rows)], pa.binary())], [key, "id", "n", "counts"])

    return docs.select(key, text).mapInArrow(lean(run), f"`{key}` {docs.schema[key].dataType.simpleString()}, id bigint, n bigint, counts binary")


def _counters(measured: DataFrame) -> np.ndarray:
    """The summed table; its size is fixed, and blocks are added up by Spark."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = total.setdefault(k, np.zeros(BLOCK, np.uint32))
                own += _unpack(raw.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([_pack(v) for v in total.values()], pa.binary())], ["block", "counts"])

    blocks = measured.where("counts is not null").select(F.col("id").alias("block"), "counts")
    summed = blocks.mapInArrow(add, "block bigint, counts binary").repartition("block").mapInArrow(add, "block bigint, counts binary")
    out = np.zeros(COUNTERS, np.uint32)
    for r in summed.collect():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = _unpack(r.counts)
    return out


def _combinations(tokens: np.ndarray, at: np.ndarray, classes: int, n: int, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures of every two tokens of a class, with the bound of the overlap that goes with them."""
    kind = (tokens >> U64(20)) % U64(classes)
    order = np.argsort(kind, kind="stable")
    tokens, at, kind = tokens[order], at[order], kind[order]
    for step in range(1, len(tokens)):
        same = kind[step:] == kind[:-step]
        if not same.any():
            break
        with np.errstate(over="ignore"):
            sig = tokens[:-step][same] * U64(0x9FB21C651E98DF25) + tokens[step:][same] + U64(2 + level)
        yield sig, np.minimum(n, classes + n - at[step:][same])


def _postings(docs: DataFrame, text: str, counts: np.ndarray, size: int, similar: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    frequent = 2 * float(counts.mean()) + 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for _, h, offsets in shingle_sets(batch.column(0), size):
                own = set_id(h, offsets)
                count = np.minimum(table[(h & U64(COUNTERS - 1)).astype(np.int64)], (1 << 23) - 1).astype(U64)
                often = count > frequent
                order_key = count << U64(40) | h >> U64(24)
                sigs, ids, sizes = [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    n = b - a
                    if not n:
                        continue
                    order = np.argsort(order_key[a:b], kind="stable") + a
                    first = n - (similar * n + 99) // 100 + 1
                    common = often[order]
                    place = np.arange(n)
                    single = place[:first][~common[:first]] if n > 1 else place
                    posted = [(h[order[single]] + U64(1), n - single)]
                    if n > 1 and common[:first].any():
                        level = n.bit_length() - 1
                        for k in {level, (100 * n // similar).bit_length() - 1}:
                            classes = max(1, (1 << k) >> 5)
                            at = place[:first + classes][common[:first + classes]]
                            posted.extend(_combinations(h[order[at]], at, classes, n, k))
                    m = sum(len(x) for x, _ in posted)
                    sigs.extend(x for x, _ in posted)
                    ids.append(np.full(m, own[i]))
                    sizes.extend((n << 32) | bound for _, bound in posted)
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(np.concatenate(sigs)).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(sizes))], ["sig", "id", "size"])

    return docs.select(text).mapInArrow(lean(run), "sig bigint, id bigint, size bigint")


def _grouped(docs: DataFrame, key: str, text: str, similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """(key, id, n, part) of each row of ``docs``: set, number of shingles and group of linked sets."""
    measured = written(_measured(docs, key, text, size), "sets")
    info = measured.where("counts is null").select(key, "id", "n")
    postings = _postings(docs, text, _counters(measured), size, similar)

    def texts_of(ids: DataFrame, once: bool = True) -> DataFrame:
        place = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"))
        wanted = written(info.join(ids, "id", "left_semi").groupBy(F.col("id").alias("_id")).agg(F.min(place).alias("first"))
                         .select("_id", F.col("first.key").alias("_key")), "wanted")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, h, offsets in shingle_sets(batch.column(1), size):
                    own = set_id(h, offsets)
                    some = np.flatnonzero(own)
                    at = pa.array(some + row)
                    texts = batch.column(1).take(at)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(own[some]), packed(texts) if once else texts], [key, "id", "text"])

        kind = f"`{key}` {docs.schema[key].dataType.simpleString()}, id bigint, text {'binary' if once else 'string'}"
        near = lambda rows: sifted(rows, F.xxhash64(key), wanted, F.xxhash64("_key")).where("_near").drop("_near")
        own = near(docs.select(key, text)).mapInArrow(lean(run), kind)
        if not once:
            return own.select("id", "text")
        # what passes the first sieve and isn't one wanted row; a row that this second sieve doesn't know needs no join
        same = lambda rows: rows[key].eqNullSafe(F.col("_key")) & (rows["id"] == F.col("_id"))
        met = near(info.where("n > 0").select(key, "id")).groupBy(key, "id").agg(F.count("*").alias("times"))
        unclear = written(met.join(wanted, same(met), "left").where("_id is null or times > 1").select(F.col(key).alias("_key"), F.col("id").alias("_id")), "unclear")
        apart = sifted(own, F.xxhash64(key, "id"), unclear, F.xxhash64("_key", "_id"))
        folder = stored(apart, "texts")
        rest = docs.sparkSession.read.schema(apart.schema).parquet(folder).where("_near")
        rest = rest.join(wanted, same(rest), "left_semi").dropDuplicates(["id"]).withColumn("_near", F.lit(False))
        # one scan of both, so that the two ends of pairs are joined with one shuffle of it
        return docs.sparkSession.read.schema(apart.schema).parquet(folder, stored(rest, "texts")).where("not _near").select("id", "text")

    parts = link(postings, texts_of, similar, size)
    with_part = info.join(parts.select(F.col("node").alias("id"), F.col("component_id").alias("part")), "id", "left")
    return with_part.withColumn("part", F.coalesce("part", "id"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """One row (key, n_shingles, set_id, component_id) for each row of ``docs``; component_id is the
    smallest key that links reach, the row's own included."""
    with_part = _grouped(docs, key, text, similar, size)
    least = with_part.where("n > 0").groupBy("part").agg(F.min(key).alias("component_id"))
    return (with_part.join(least, "part", "left")
            .select(key, F.col("n").alias("n_shingles"), F.col("id").alias("set_id"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id")))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked documents stays: the one with the group's smallest (key, set),
    a null key last, and any one of several that have both; texts without words stay.  All columns
    keep their values."""
    rows = written(_grouped(docs, key, text).where("n > 0").groupBy("part", key, "id").agg(F.count("*").alias("times")), "rows")
    place = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"), "id")
    first = rows.groupBy("part").agg(F.min(F.struct(*(place.getField(c).alias(c) for c in ("unknown", "key", "id")), "times")).alias("first"))
    stay = written(first.select(F.col("first.key").alias("_key"), F.col("first.id").alias("_id"), F.col("first.times").alias("_times")), "stay")
    several = written(stay.where("_times > 1"), "several")  # mostly few: a table of its own, so that its size is known
    # a row that is its group's first one and has no equals stays as it is; only the others are shuffled with their texts
    single = stay.where("_times = 1")
    decided = written(rows.select(F.col(key).alias("_key"), F.col("id").alias("_id")).subtract(single.select("_key", "_id")), "decided")

    order, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [set_id(h, offsets) for _, h, offsets in shingle_sets(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64))], [*order, "_set"])

    own = docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField("_set", LongType())]))
    same = lambda some, few: some[key].eqNullSafe(few["_key"]) & (some["_set"] == few["_id"])
    apart = sifted(own, F.xxhash64(key, "_set"), decided, F.xxhash64("_key", "_id"))
    near = apart.where("_near and _set != 0").drop("_near")
    out = near.join(single, same(near, single), "left_semi")
    out = out.unionByName(near.join(several, same(near, several), "left_semi").dropDuplicates([key, "_set"]))
    return out.unionByName(apart.where("not _near or _set = 0").drop("_near")).drop("_set")
