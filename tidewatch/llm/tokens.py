"""Token ids of many texts at once: every distinct piece of text is encoded once per task.

Texts are cut only where the tokenizers' own pre-tokenisation always cuts, so the ids of a text
are those of its pieces one after another.  Such places need no Unicode tables:

* between an ASCII letter or digit and ASCII punctuation other than an apostrophe, and back;
* at a single ASCII white-space byte between a non-space byte and an ASCII graphic character: a
  byte-level pre-token begins with a space, so it cuts before the space (and behind it too for a
  tab or line end); a word vocabulary drops white space, so it cuts at every white space.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .textbytes import SPACE, gather, hash_spans, utf8_chunks, words

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
_PUNCT &= ~_ALNUM
_PUNCT[39] = False  # apostrophes begin contractions
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[33:127] = True

#: Distinct pieces that a worker remembers before it starts anew (about 40 bytes each).
CACHE_PIECES = 1_000_000


def _class_cuts(data: np.ndarray) -> np.ndarray:
    alnum, punct = _ALNUM[data], _PUNCT[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (alnum[:-1] & punct[1:]) | (punct[:-1] & alnum[1:])
    return cut


def byte_level_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that byte-level pre-tokenisation never joins: starts, ends, pieces before each text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space, cut = SPACE[data], _class_cuts(data)
    alone = np.zeros(n, bool)
    alone[1:-1] = space[1:-1] & ~space[:-2] & _GRAPHIC[data[2:]]
    edge = offsets[(offsets > 0) & (offsets < n)]
    alone[edge] = False  # the neighbours belong to other texts
    alone[edge - 1] = False
    cut |= alone
    cut[1:] |= alone[:-1] & (data[:-1] != 32)
    cut[edge] = True
    cut[0] = True
    starts = np.flatnonzero(cut)
    return starts, np.r_[starts[1:], n], np.searchsorted(starts, offsets)


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces for a vocabulary of words, which drops white space."""
    starts, ends, _ = words(data, offsets)
    cuts = np.flatnonzero(_class_cuts(data)) if len(data) else starts
    starts = np.union1d(starts, cuts)
    ends = np.union1d(ends, cuts)
    return starts, ends, np.searchsorted(starts, offsets)


def with_literals(pieces: Callable, literals: list[bytes]) -> Callable:
    """``pieces`` that keep each literal of an added token whole, leftmost first within a text, and
    cut right before and behind it."""
    if not literals:
        return pieces
    pattern = re.compile(b"|".join(re.escape(x) for x in sorted(literals, key=len, reverse=True)))

    def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, before = pieces(data, offsets)
        raw = data.tobytes()
        if not pattern.search(raw):
            return starts, ends, before
        found = [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in pattern.finditer(raw, a, b)]
        if not found:  # it only runs over the end of a text
            return starts, ends, before
        first, last = np.array(found).T
        joined = np.zeros(len(data) + 1, bool)  # places inside a literal
        for a, b in found:
            joined[a + 1:b] = True
        gone = np.zeros(len(data) + 1, bool)  # white space that no piece covers
        covered = np.zeros(len(data) + 2, np.int32)
        np.add.at(covered, starts, 1)
        np.add.at(covered, ends, -1)
        gone[:-1] = np.cumsum(covered)[:len(data)] == 0
        behind = last[last < len(data)]
        starts = np.union1d(starts[~joined[starts]], np.r_[first, behind[~gone[behind]]])
        ahead = first[first > 0]
        ends = np.union1d(ends[~joined[ends]], np.r_[last, ahead[~gone[ahead - 1]]])
        return starts, ends, np.searchsorted(starts, offsets)

    return cut


class PieceCache:
    """Ids of distinct pieces by their 64-bit hash, as sorted arrays over one pool of ids."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def look_up(self, keys: np.ndarray, bytes_of: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of each of the sorted distinct keys stand, and how many."""
        if len(self.keys) > CACHE_PIECES:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ids = self.encode(bytes_of(new))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            begin = len(self.pool) + np.cumsum(sizes) - sizes
            self.pool = np.concatenate([self.pool, np.fromiter((x for one in ids for x in one), np.uint32, int(sizes.sum()))])
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.start = np.insert(self.start, at[new], begin)
            self.size = np.insert(self.size, at[new], sizes)
            at = np.searchsorted(self.keys, keys)
        return self.start[at], self.size[at]


def encode_texts(texts: pa.Array, pieces: Callable, cache: PieceCache) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets of ids) for runs of rows of a batch; null texts have no ids."""
    for row, data, offsets in utf8_chunks(texts):
        starts, ends, before = pieces(data, offsets)
        keys, first, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        where, size = cache.look_up(keys, lambda new: [raw[starts[i]:ends[i]] for i in first[new]])
        sizes = size[back]
        total = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        yield row, gather(cache.pool, where[back], sizes), total[before]


_tokenizers: dict[str, object] = {}


def library_tokenizer(path: str):
    """The worker's only copy of one vocabulary."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def library_encoder(path: str) -> Callable[[list[bytes]], list[list[int]]]:
    """Ids of pieces by the tokenizers library, without special tokens around them; a piece that is the literal of
    an added token gets its id, as by the library's default."""
    tokenizer = library_tokenizer(path)
    return lambda batch: [e.ids for e in tokenizer.encode_batch_fast([b.decode("utf-8") for b in batch], add_special_tokens=False)]


def library_pieces(path: str, pieces: Callable) -> Callable:
    """``pieces`` that keep the literals of the vocabulary's added tokens whole."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
        raise ValueError("added tokens with conditions")
    return with_literals(pieces, [a["content"].encode() for a in added])


_caches: dict[tuple, PieceCache] = {}


def cache_for(kind: str, path: str, encoder: Callable[[str], Callable]) -> PieceCache:
    """The worker's cache for one vocabulary; it lives as long as the Python worker does."""
    if (kind, path) not in _caches:
        _caches[kind, path] = PieceCache(encoder(path))
    return _caches[kind, path]
