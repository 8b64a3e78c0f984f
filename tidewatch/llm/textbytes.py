"""Array arithmetic over the UTF-8 bytes of many texts at once (used inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_R = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_R_INV = U64(pow(int(_R), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK_BYTES = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK_BYTES, 1 << int(n).bit_length())
    if size not in _powers:
        if len(_powers) > 1:  # a very long text came by; keep only the usual size
            for k in [k for k in _powers if k != CHUNK_BYTES]:
                del _powers[k]
        with np.errstate(over="ignore"):
            _powers[size] = tuple(np.cumprod(np.r_[U64(1), np.full(size, r, U64)]) for r in (_R, _R_INV))
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]``, the same wherever the bytes stand."""
    if not len(starts):
        return np.zeros(0, U64)
    power, inverse = _pow(len(data))
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, U64)
        total[0] = 0
        np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def utf8_chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about CHUNK_BYTES; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, off, buf = texts.buffers()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all maximal runs without ASCII white space, and for each text the
    number of words before it (length: texts + 1)."""
    n = len(data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    start_at, end_at = step == 1, step == -1
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    joined = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]  # a word runs over the end of a text
    start_at[joined] = True
    end_at[joined] = True
    starts, ends = np.flatnonzero(start_at), np.flatnonzero(end_at)
    return starts, ends, np.searchsorted(starts, offsets)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[starts[i]:starts[i] + lengths[i]]`` for all i, one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]
