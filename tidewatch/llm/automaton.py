"""BPE encoding and decoding with a tokenization automaton.

The merges of a vocabulary are compiled, one after another, into a deterministic automaton whose
arcs carry tokens and whose paths from the start state spell exactly the right encodings.  It begins
as one state with a loop for each byte.  The gadget of a merge (u, v) -> w, applied where an arc u
is followed by an arc v,

* leads every arc u to a copy of its target that has no arc v, and
* adds, at every state that has an arc u, an arc w to where the arc v led.

All arcs of one label lead to one state, so a state is known by the label read last, and a merge adds
one state at most.  A state is kept as (state that it is a copy of, merge that made it, label that it
lost): it has an arc y, if y is older than the copy, when the original has it and it isn't the
lost one, and, if y is younger, when it has an arc of the left half of y.  So the tables are linear in the
vocabulary, and an arc once looked up is remembered.

A pre-split word has one path only.  It is walked by the longest arc that the state allows; a
place without a way on is marked, so that it is visited once, and a word of n bytes costs O(n)
steps.  Decoding emits the labels of the arcs.

Null text is empty: no ids and empty decoded text.  Rows, also repeated ones, are encoded one by one;
columns other than the key and the text are ignored.  Literals of added tokens in a text get their
ids, as by the library's default; truncation and padding of the file are not applied.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textbytes import gather
from .tokens import PieceCache, byte_level_pieces, encode_texts, with_literals

#: Arcs that a worker remembers before it starts anew.
MEMO = 1_000_000


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable
    in Latin-1, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, free = [], 256
    for b in range(256):
        names.append(chr(b if b in plain else free))
        free += b not in plain
    return names


class Automaton:
    """The compiled automaton of merges over tokens; ``tokens[i]`` is the bytes of id i."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]]):
        size = max(tokens, default=-1) + 1
        self.tokens = [tokens.get(i, b"") for i in range(size)]
        self.id_of = {t: i for i, t in tokens.items()}
        self.left = [-1] * size
        self.made = [-1] * size      # number of the merge that makes a token; 0 for single bytes
        self.target = [0] * size     # the state behind an arc of this label
        for i, t in tokens.items():
            if len(t) == 1:
                self.made[i] = 0
        self.copy_of, self.since, self.lost = [0], [0], [-1]
        for k, (u, v, w) in enumerate(merges, 1):
            self._gadget(k, u, v, w)
        self.allowed: dict[int, bool] = {}
        self._labels()

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.made[w] >= 0:
            raise ValueError(f"two merges make token {w}")
        if self.made[u] < 0 or self.made[v] < 0 or not self.has_arc(self.target[u], v):
            return  # no path has u before v, so the merge never happens
        self.left[w], self.made[w], self.target[w] = u, k, self.target[v]
        self.copy_of.append(self.target[u])
        self.since.append(k)
        self.lost.append(v)
        self.target[u] = len(self.since) - 1

    def has_arc(self, state: int, label: int) -> bool:
        made, left, since, lost, copy_of = self.made, self.left, self.since, self.lost, self.copy_of
        if made[label] < 0:
            return False
        while state:
            age = since[state]
            while made[label] >= age:
                label = left[label]
            if lost[state] == label:
                return False
            state = copy_of[state]
        return True

    def follows(self, last: int, label: int) -> bool:
        """Whether the state behind ``last`` has an arc ``label``."""
        key = last * len(self.tokens) + label
        out = self.allowed.get(key)
        if out is None:
            if len(self.allowed) >= MEMO:
                self.allowed.clear()
            out = self.allowed[key] = self.has_arc(self.target[last], label)
        return out

    def _labels(self) -> None:
        """The labels as a byte trie, and for each one the next shorter label that begins it."""
        self.step: dict[int, int] = {}
        at: list[int] = [-1]
        for i, t in enumerate(self.tokens):
            if self.made[i] < 0:
                continue
            node = 0
            for b in t:
                nxt = self.step.get(node << 8 | b)
                if nxt is None:
                    nxt = self.step[node << 8 | b] = len(at)
                    at.append(-1)
                node = nxt
            at[node] = i
        self.at = at
        self.shorter = [-1] * len(self.tokens)
        for i, t in enumerate(self.tokens):
            node = 0
            for b in t[:-1]:
                node = self.step.get(node << 8 | b, -1)
                if node < 0:
                    break
                if at[node] >= 0:
                    self.shorter[i] = at[node]

    def _longest(self, raw: bytes, pos: int) -> int:
        node, found, step, at = 0, -1, self.step.get, self.at
        for b in raw[pos:pos + 16] if len(raw) - pos > 16 else raw[pos:]:
            node = step(node << 8 | b)
            if node is None:
                return found
            if at[node] >= 0:
                found = at[node]
        for k in range(pos + 16, len(raw)):
            node = step(node << 8 | raw[k])
            if node is None:
                return found
            if at[node] >= 0:
                found = at[node]
        return found

    def encode_word(self, raw: bytes) -> list[int]:
        """Labels of the only path that spells ``raw``."""
        whole = self.id_of.get(raw)
        if whole is not None and self.made[whole] >= 0:
            return [whole]  # the start state has every arc
        n, pos, path = len(raw), 0, []
        dead = bytearray(n + 1)
        tokens, shorter, follows = self.tokens, self.shorter, self.follows
        label = self._longest(raw, 0) if n else -1
        while pos < n:
            while label >= 0:
                end = pos + len(tokens[label])
                if not dead[end] and (not path or follows(path[-1], label)):
                    break
                label = shorter[label]
            if label >= 0:
                path.append(label)
                pos = end
                if pos < n:
                    label = self._longest(raw, pos)
            elif path:
                dead[pos] = 1
                label = path.pop()
                pos -= len(tokens[label])
                label = shorter[label]
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return path


class Vocabulary:
    """A byte-level vocabulary file of the tokenizers library, compiled."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or spec["normalizer"] or any(
                model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("not a plain byte-level BPE vocabulary")
        byte_of = {c: b for b, c in enumerate(byte_names())}
        self.spell = lambda s: bytes([byte_of[c] for c in s])
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        added = spec["added_tokens"]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens with conditions")
        self.literals = {a["content"].encode(): a["id"] for a in added}
        special = set(self.literals.values())
        self.automaton = Automaton({i: self.spell(s) for s, i in ids.items() if i not in special}, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=bool(split.get("add_prefix_space")), use_regex=True).pre_tokenize_str
        by_id = dict(enumerate(self.automaton.tokens)) | {i: t for t, i in self.literals.items()}
        labels = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.size = np.fromiter(map(len, labels), np.int64, len(labels))
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(labels) or b"\0", np.uint8)
        self.pieces = with_literals(byte_level_pieces, list(self.literals))
        self.cache = PieceCache(lambda batch: [self.encode_piece(b) for b in batch])

    def encode_piece(self, raw: bytes) -> list[int]:
        literal = self.literals.get(raw)
        if literal is not None:
            return [literal]
        if raw[raw[:1] == b" ":].isalpha():  # ASCII letters behind a space at most: one word
            return self.automaton.encode_word(raw)
        out: list[int] = []
        for word, _ in self.split(raw.decode("utf-8")):
            out += self.automaton.encode_word(self.spell(word))
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids: the labels' bytes one after another."""
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.size[ids], out=total[1:])
        data = gather(self.bytes, self.begin[ids], self.size[ids]).tobytes()
        ends = total[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


_made: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's compiled vocabulary; it lives as long as the Python worker does."""
    if path not in _made:
        _made[path] = Vocabulary(path)
    return _made[path]


_TYPES = {"ids": "array<int>", "decoded": "string", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def _columns(ids: np.ndarray, offsets: np.ndarray, decoded: Callable[[], list[str]]) -> dict[str, Callable[[], pa.Array]]:
    runs = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
    return {
        "ids": lambda: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))),
        "decoded": lambda: pa.array(decoded(), pa.string()),
        "n_tokens": lambda: pa.array(np.diff(offsets), pa.int64()),
        "ids_sha256": lambda: pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in runs], pa.string()),
        "decoded_sha256": lambda: pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded()], pa.string()),
    }


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """(key, columns ...) of each row of ``docs``; ``columns`` chooses among ids, decoded (the text that
    they decode to), n_tokens, ids_sha256 (little-endian unsigned 32-bit ids) and decoded_sha256."""
    schema = ", ".join([f"`{key}` {docs.schema[key].dataType.simpleString()}", *(f"{c} {_TYPES[c]}" for c in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for row, ids, offsets in encode_texts(batch.column(1), v.pieces, v.cache):
                ids = ids.astype("<u4")
                made = _columns(ids, offsets, lambda: v.decode(ids, offsets))  # noqa: B023
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(offsets) - 1), *(made[c]() for c in columns)], [key, *columns])

    return docs.select(key, text).mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of each row's array of ids; null ids are an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            rows = [r or [] for r in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, rows)])
            flat = np.fromiter((x for r in rows for x in r), np.int64, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(v.decode(flat, offsets), pa.string())], [key, "text"])

    return docs.select(key, ids).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, text string")
