"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is a linked list of byte spans.  Every pair that the vocabulary can merge waits in
the bucket of its rank; two levels of bitmaps tell which buckets hold something, and find-first-set
on them gives the lowest rank.  A bucket is worked off from left to right.  Entries
whose pair has changed meanwhile are stale and are skipped.  A pre-token of n bytes costs O(n)
queue steps however long it is.

Null text is empty: no ids, and the digest of no bytes.  Rows, also repeated ones, are encoded one
by one; columns of the input other than the key and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textbytes import gather
from .tokens import byte_level_pieces, cache_for, encode_texts


#: Ranks of one leaf word; the word above has a bit for each leaf word in use.
LEAF_BITS = 8
_BIT = [1 << k for k in range(1 << LEAF_BITS)]
_LEAF_MASK = (1 << LEAF_BITS) - 1


class RankQueue:
    """Positions by merge rank under two levels of bitmaps; find-first-set on each gives the lowest rank."""

    def __init__(self, ranks: int):
        self.leaf = [0] * ((ranks >> LEAF_BITS) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(at)
            return
        self.buckets[rank] = [at]
        k = rank >> LEAF_BITS
        word = self.leaf[k]
        if not word:
            self.top |= 1 << k
        self.leaf[k] = word | _BIT[rank & _LEAF_MASK]

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank in use and its positions from left to right; its bucket is empty then."""
        top = self.top
        k = (top & -top).bit_length() - 1
        word = self.leaf[k]
        low = word & -word
        self.leaf[k] = word = word ^ low
        if not word:
            self.top = top & (top - 1)
        rank = k << LEAF_BITS | low.bit_length() - 1
        bucket = self.buckets.pop(rank)
        if len(bucket) > 1:
            bucket.sort()
        return rank, bucket


class ByteBPE:
    """A vocabulary of byte strings with ranks (lines of base64 and rank) and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.ranks.values(), default=0))
        self.tokens = np.zeros(0, np.uint8)

    def encode_pretoken(self, raw: bytes) -> list[int]:
        rank_of, queue = self.ranks.get, self.queue
        whole = rank_of(raw)
        if whole is not None:
            return [whole]
        n, push = len(raw), queue.push
        after = list(range(1, n + 1))   # where the span at a position ends
        before = list(range(-1, n))     # where the span that ends at a position begins
        # rank of the pair that begins at a position
        rank_at = [rank_of(raw[i:i + 2], -1) for i in range(n - 1)]
        rank_at += (-1, -1)
        for i, r in enumerate(rank_at):
            if r >= 0:  # -1 is no pair
                push(r, i)
        while queue.top:
            rank, bucket = queue.take()
            for k, i in enumerate(bucket):
                if rank_at[i] != rank:
                    continue  # stale
                j = after[i]
                after[i] = end = after[j]
                before[end] = i
                rank_at[j] = -1
                lower = rank
                rank_at[i] = r = rank_of(raw[i:after[end]], -1) if end < n else -1
                if r >= 0:
                    push(r, i)
                    lower = r
                h = before[i]
                if h >= 0:
                    rank_at[h] = r = rank_of(raw[h:end], -1)
                    if r >= 0:
                        push(r, h)
                        if r < lower:
                            lower = r
                if lower < rank:  # a lower rank has come up; the rest of the bucket waits
                    for m in bucket[k + 1:]:
                        push(rank, m)
                    break
        ids, i = [], 0
        while i < n:
            j = after[i]
            ids.append(rank_of(raw[i:j]))
            i = j
        return ids

    def encode_piece(self, raw: bytes) -> list[int]:
        if raw[raw[:1] == b" ":].isalpha():  # ASCII letters behind a space at most: one pre-token
            return self.encode_pretoken(raw)
        out: list[int] = []
        for token in self.find(raw.decode("utf-8")):
            out += self.encode_pretoken(token.encode("utf-8"))
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        if not len(self.tokens):
            size = max(self.ranks.values(), default=-1) + 1
            by_id = [b""] * size
            for token, r in self.ranks.items():
                by_id[r] = token
            self.size = np.fromiter(map(len, by_id), np.int64, size)
            self.begin = np.cumsum(self.size) - self.size
            self.tokens = np.frombuffer(b"".join(by_id) or b"\0", np.uint8)
        sizes = self.size[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        data = gather(self.tokens, self.begin[ids], sizes).tobytes()
        ends = total[offsets]
        return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


_made: dict[tuple[str, str], ByteBPE] = {}


def vocabulary(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _made:
        _made[path, pattern] = ByteBPE(path, pattern)
    return _made[path, pattern]


def _encoder(pattern: str) -> Callable[[str], Callable]:
    return lambda path: lambda batch: [vocabulary(path, pattern).encode_piece(b) for b in batch]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """(key, ids ...) of each row of ``docs``; ``columns`` chooses among

    * ids: array of int;
    * decoded: the text that the ids decode to, as binary;
    * n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256.
    """
    types = {"ids": "array<int>", "decoded": "binary", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = ", ".join([f"`{key}` {docs.schema[key].dataType.simpleString()}", *(f"{c} {types[c]}" for c in columns)])
    wants_bytes = bool({"decoded", "decoded_sha256"} & set(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        cache = cache_for("bpe", path, _encoder(pattern))
        for batch in batches:
            for row, ids, offsets in encode_texts(batch.column(1), byte_level_pieces, cache):
                n = len(offsets) - 1
                ids = ids.astype("<u4")
                runs = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                decoded = bpe.decode(ids, offsets) if wants_bytes else []
                out = {
                    "ids": lambda: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))),
                    "decoded": lambda: pa.array(decoded, pa.binary()),
                    "n_tokens": lambda: pa.array(np.diff(offsets), pa.int64()),
                    "ids_sha256": lambda: pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in runs], pa.string()),
                    "decoded_sha256": lambda: pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                }
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), *(out[c]() for c in columns)], [key, *columns])

    return docs.select(key, text).mapInArrow(run, schema)
