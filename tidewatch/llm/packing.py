"""Order-preserving packing: dynamic programming chooses where the stream of tokens is cut.

The documents of a scan partition, in their order, make one stream of ids (each document ends
with its end id).  A window of at most ``size`` ids becomes one sequence.  Candidate cuts stand at
document ends, at sentence ends (ids whose text ends a sentence) and, so that no stretch is
without one, at every ``grid``-th id after the last candidate.  The cost of a window is its padding
plus the penalty of the cut at its end: nothing at a document's end, ``sentence_cost`` at a sentence's,
``inner_cost`` elsewhere.  Because padding is linear in the cut's place, the best predecessor is the
least value of a sliding window, which a monotone queue gives in constant time per candidate.

Every id lies in exactly one piece and pieces follow the order of the stream.  No document is
moved between tasks; a stream has at most ``STRETCH`` ids at a time, so memory is bounded, and
each stretch's last sequence alone can be short.  A short sequence keeps its length when that is a
power of two and is padded to ``size`` otherwise.

Null text is empty: its document is the end id alone.  Repeated rows are packed one by one.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import lean, release
from .tokens import byte_level_pieces, cache_for, encode_texts, library_encoder, library_pieces, library_tokenizer

#: Ids that are planned together; a stream is planned in stretches of at least so many, cut at document ends.
STRETCH = 1_500_000
SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def plan_cuts(place: np.ndarray, penalty: np.ndarray, size: int) -> np.ndarray:
    """The chosen subset of the candidate ``place``s (ascending; the last one is the stream's end).

    place[k] - place[k - 1] must be at most ``size``.  Ties go to the earlier predecessor.
    """
    at, cost = place.tolist(), penalty.tolist()
    best = [0] * (len(at) + 1)          # best[0]: nothing packed yet
    back = [0] * (len(at) + 1)
    where = [0, *at]
    queue = deque([(0, 0)])             # (best + place, index), values rising
    first = 0
    for k in range(1, len(at) + 1):
        low = where[k] - size
        while where[queue[0][1]] < low:
            queue.popleft()
        value, back[k] = queue[0]
        value += size - where[k] + cost[k - 1]
        best[k] = value
        value += where[k]
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, k))
    out, k = [], len(at)
    while k > first:
        out.append(where[k])
        k = back[k]
    return np.array(out[::-1], np.int64)


def candidates(ids: np.ndarray, ends: np.ndarray, ends_sentence: np.ndarray, grid: int, sentence_cost: int, inner_cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, and what each costs."""
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[1:][ends_sentence[ids]] = sentence_cost
    cost[ends] = 0
    known = np.r_[0, np.flatnonzero(cost >= 0)]
    gaps = np.diff(known)
    wide = np.flatnonzero(gaps > grid)
    if len(wide):
        count = (gaps[wide] - 1) // grid
        at = np.repeat(known[wide], count) + grid * (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + 1)
        cost[at] = inner_cost
    cost[0] = -1
    place = np.flatnonzero(cost >= 0)
    return place, cost[place]


@lru_cache(2)
def sentence_ends(path: str) -> np.ndarray:
    """For each id, whether its text ends with a full stop, question or exclamation mark or line end."""
    vocabulary = library_tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        out[i] = token.endswith((".", "!", "?", "Ċ"))  # the last one stands for a line feed
    return out


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 2048, end_id: int = 1, grid: int = 64, sentence_cost: int = 2, inner_cost: int = 12) -> DataFrame:
    """One row for each piece: key, start (the document's ids before it), length, ids_crc32 (of
    little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset (in the sequence).

    sequence_id is the task's partition times 2**40 plus the sequence's number there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        cache, pieces = cache_for("library", path, library_encoder), library_pieces(path, byte_level_pieces)
        ends_sentence = sentence_ends(path)
        held_keys: list[pa.Array] = []
        held_ids: list[np.ndarray] = []
        held_sizes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            keys, ids, sizes = pa.concat_arrays(held_keys), np.concatenate(held_ids), np.concatenate(held_sizes)
            for held in (held_keys, held_ids, held_sizes):
                held.clear()
            ends = np.cumsum(sizes)
            cuts = plan_cuts(*candidates(ids, ends, ends_sentence, grid, sentence_cost, inner_cost), size)
            stops = np.union1d(cuts, ends)
            begins = np.r_[0, stops[:-1]]
            doc = np.searchsorted(ends, begins, "right")
            sequence = np.searchsorted(cuts, begins, "right")
            first = np.r_[0, cuts][sequence]
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
            out = pa.RecordBatch.from_arrays(
                [keys.take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (begins - (ends - sizes)[doc], stops - begins, crc, sizes[doc], sequence + number, begins - first))],
                [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            number += len(cuts)
            return out

        held = 0
        for batch in batches:
            for row, ids, offsets in encode_texts(batch.column(1), pieces, cache):
                n = len(offsets) - 1
                sizes = np.diff(offsets) + 1
                held_keys.append(batch.column(0).slice(row, n))
                held_ids.append(np.insert(ids, offsets[1:], end_id))
                held_sizes.append(sizes)
                held += int(sizes.sum())
                if held >= STRETCH:
                    yield flush()
                    held = 0
                    release()
        if held:
            yield flush()

    return docs.select(key, text).mapInArrow(lean(run), f"`{key}` {docs.schema[key].dataType.simpleString()}, {SCHEMA}")
