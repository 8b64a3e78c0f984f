"""Token-ID files: texts become ids, ids become checksummed range-coded blocks, files are read back.

A file is a Parquet file of one task whose rows are blocks (file, block, first id, the documents that
begin in it or run on, and the packed block of ``rangecoder``).  Files follow each other in ascending key
order, as do blocks in a file, so the ids of all files form one stream.  Blocks are reset one by one: any
of them is decoded alone, and a damaged one is noticed by its CRC-32.

Null text is empty: its document is the end id alone.  Null keys come first; rows of equal key are
ordered by the hash of their text.  Columns other than key and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .rangecoder import BLOCK_IDS, pack_blocks, unpack_blocks
from .tokens import cache_for, encode_texts, library_encoder, library_pieces, word_pieces

#: Blocks that are coded in step: enough to spread numpy's cost per call, few enough for 100 MB of state.
LANES = 1_024


def write(docs: DataFrame, path: str, pieces=word_pieces, key: str = "doc_id", text: str = "text", end_id: int = 1) -> DataFrame:
    """The written blocks: file, block, first (the file's ids before it), keys, sizes (ids in this block of each
    document), skipped (the first document's ids in earlier blocks), ordinal (its number in the file), n_ids, packed."""
    kind = docs.schema[key].dataType.simpleString()
    ordered = (docs.select(key, text).withColumn("_h", F.xxhash64(text)).repartitionByRange(F.asc_nulls_first(key), "_h")
               .sortWithinPartitions(F.asc_nulls_first(key), "_h").select(key, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        cache, whole = cache_for("library", path, library_encoder), library_pieces(path, pieces)
        keys, ids, sizes = [], [], []
        held, block, first, ordinal, carried = 0, 0, 0, 0, 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, block, first, ordinal, carried, keys, ids, sizes
            all_keys, stream, size = pa.concat_arrays(keys), np.concatenate(ids), np.concatenate(sizes)
            n = len(stream) if last else len(stream) // BLOCK_IDS * BLOCK_IDS
            packed = pack_blocks(stream[:n])
            ends = np.cumsum(size)
            begins = ends - size
            rows = []
            for k in range(len(packed)):
                a, b = k * BLOCK_IDS, min((k + 1) * BLOCK_IDS, n)
                i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(begins, b, "left"))
                part = np.minimum(ends[i:j], b) - np.maximum(begins[i:j], a)
                skipped = a - int(begins[i]) + (carried if i == 0 else 0)
                rows.append((i, j, part, skipped, b - a))
            yield pa.RecordBatch.from_arrays([
                pa.array([file] * len(rows), pa.int32()), pa.array(range(block, block + len(rows)), pa.int32()),
                pa.array([first + k * BLOCK_IDS for k in range(len(rows))], pa.int64()),
                pa.array([all_keys[i:j].to_pylist() for i, j, *_ in rows], pa.list_(all_keys.type)),
                pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.int64()),
                pa.array([ordinal + r[0] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int32()), pa.array(packed, pa.binary())],
                ["file", "block", "first", "keys", "sizes", "skipped", "ordinal", "n_ids", "packed"])
            # what is left begins in the last document that has ids beyond the blocks
            i = int(np.searchsorted(ends, n, "right"))
            block, first, ordinal = block + len(packed), first + n, ordinal + i
            carried = (n - int(begins[i]) + (carried if i == 0 else 0)) if i < len(size) else 0
            rest = size[i:].copy()
            if len(rest):
                rest[0] = ends[i] - n
            keys, ids, sizes = [all_keys[i:]], [stream[n:]], [rest]
            held = len(stream) - n

        for batch in batches:
            for row, x, offsets in encode_texts(batch.column(1), whole, cache):
                m = len(offsets) - 1
                keys.append(batch.column(0).slice(row, m))
                ids.append(np.insert(x, offsets[1:], end_id))
                sizes.append(np.diff(offsets) + 1)
                held += len(ids[-1])
                if held >= LANES * BLOCK_IDS:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return written(ordered.mapInArrow(run, f"file int, block int, first bigint, keys array<{kind}>, sizes array<int>, skipped bigint, ordinal bigint, n_ids int, packed binary"), "tokens")


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def crc_join(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings end to end from theirs and the second one's length."""
    odd = [0xEDB88320, *(1 << k for k in range(31))]   # one zero bit
    for _ in range(3):                                   # one zero byte
        odd = [_times(odd, row) for row in odd]
    while length:
        if length & 1:
            first = _times(odd, first)
        odd = [_times(odd, row) for row in odd]
        length >>= 1
    return first ^ second


def read(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the decoded blocks.

    A task combines the parts of a document that it reads; parts in different tasks are put
    together by their checksums, a few numbers for each.
    """
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "file", "ordinal", "at", "n", "crc"]
        types = None
        open_ = None     # the last document's part, which the next block may continue
        for batch in batches:
            for s in range(0, batch.num_rows, LANES):
                some = batch.slice(s, LANES)
                if types is None:
                    types = [batch.schema.field("keys").type.value_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                done = []
                heads = [some.column(c).to_pylist() for c in range(6)]
                for k, ids in enumerate(unpack_blocks(some.column(6).to_pylist())):
                    file, ordinal, at, keys, sizes, skipped = (h[k] for h in heads)
                    raw, place = memoryview(ids).cast("B"), 0
                    for d, (name, size) in enumerate(zip(keys, sizes, strict=True)):
                        part = raw[4 * place:4 * (place + size)]
                        begin = skipped if d == 0 else 0
                        if open_ and d == 0 and begin and open_[1:3] == [file, ordinal] and open_[6] == begin:
                            open_[4] += size
                            open_[5] = zlib.crc32(part, open_[5])
                            open_[6] += size
                        else:
                            if open_:
                                done.append(open_[:6])
                            # where the part stands in its file, its size and checksum, and the document's ids up to its end
                            open_ = [name, file, ordinal + d, at + place, size, zlib.crc32(part), begin + size]
                        place += size
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(open_[:6], types, strict=True)], names)

    parts = (blocks.select("file", "ordinal", "first", "keys", "sizes", "skipped", "packed")
             .mapInArrow(run, f"`{key}` {kind}, file int, ordinal bigint, at bigint, n bigint, crc bigint"))
    whole = parts.groupBy("file", "ordinal").agg(F.first(key, ignorenulls=True).alias(key), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
                                                 F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pieces in batch.column(4).to_pylist():
                crc = pieces[0]["crc"]
                for p in pieces[1:]:
                    crc = crc_join(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], [key, "file", "at", "n_tokens", "ids_crc32"])

    whole = whole.select(key, "file", "at", "n_tokens", "parts").mapInArrow(join, f"`{key}` {kind}, file int, at bigint, n_tokens bigint, ids_crc32 bigint")
    # one row for each file: how many ids stand in the files before it
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("c"))
    before = files.select("file", (F.sum("c").over(Window.orderBy("file")) - F.col("c")).alias("before"))
    return whole.join(before, "file").select(key, (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
