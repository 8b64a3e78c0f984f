"""Token ids, byte-level BPE, packing, the range coder and token files against the libraries."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewatch.llm import bpe, common, packing, queries, rangecoder, tokenfile, tokens

from ..conftest import SF001
from .conftest import with_clashes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = [*"abcdeABCxyz'''sd0123 \t\n\n   .,!?=<>|-_", "é", "ß", " ", "̸", "́", " ", "\x85", "\x1c", "　", "日", "😀", "İ", "Σ",
            "<|endoftext|>", "'re", "'ll", "\r\n", "½", "​", "\x0b"]


LITERALS = ["  <|endoftext|>  x", "<|endof", "text|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "\t<|endoftext|>\n\n", "x <|startoftext|>é", "<|ENDOFTEXT|>",
            "<<|endoftext|>>", "<|endoftext|><|startoftext|> <|endoftext|>"]


def texts(n=400):
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(n)] + [None, "", "a" * 9000, "ab" * 3000, " " * 900, "日本" * 900, *LITERALS]


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def all_ids(values, pieces, cache):
    return [ids[a:b].tolist() for _, ids, o in tokens.encode_texts(pa.array(values, pa.string()), pieces, cache) for a, b in zip(o[:-1], o[1:], strict=True)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_library_ids(library, name):
    pieces = tokens.library_pieces(public_tokenizers.path(name), tokens.word_pieces if name.startswith("word") else tokens.byte_level_pieces)
    have = all_ids(texts(), pieces, tokens.PieceCache(tokens.library_encoder(public_tokenizers.path(name))))
    assert have == [e.ids for e in library[name].encode_batch([t or "" for t in texts()], add_special_tokens=False)]


def test_bpe_equals_the_library_and_decodes(reference):
    have = all_ids(texts(), tokens.byte_level_pieces, tokens.PieceCache(bpe._encoder(public_tokenizers.PATTERN)(RANKS)))
    assert have == [reference.encode_ordinary(t or "") for t in texts()]
    flat = np.concatenate([np.array(x, np.uint32) for x in have])
    offsets = np.cumsum([0] + [len(x) for x in have])
    assert bpe.vocabulary(RANKS, public_tokenizers.PATTERN).decode(flat, offsets) == [(t or "").encode() for t in texts()]


def test_bpe_query(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = queries.QUERIES["op5_bpe"](spark, SF001).collect()
    assert len(out) == len(docs)
    for r in out:
        t = docs[r.doc_id] or ""
        ids = np.array(reference.encode_ordinary(t), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_bpe_columns_and_empty_table(spark):
    out = {r.doc_id: r for r in bpe.encode(with_clashes(spark, [(1, "hello world"), (1, "hello world"), (2, None)]), RANKS, public_tokenizers.PATTERN, columns=("ids", "decoded")).collect()}
    assert bytes(out[1].decoded) == b"hello world"
    assert out[2].ids == []
    assert bpe.encode(with_clashes(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_cache_keeps_very_many_ids_of_a_piece():
    cache = tokens.PieceCache(lambda batch: [range(70_000) if b == b"long" else [1] for b in batch])
    keys = np.array([3, 9], np.uint64)
    for _ in range(2):
        start, size = cache.look_up(keys, lambda new: [[b"long", b"x"][i] for i in new])
        assert size.tolist() == [70_000, 1]
        assert cache.pool[start[1]] == 1


def best_cost(place, penalty, size):
    cost = {0: 0}
    for p, c in zip(place, penalty, strict=True):
        cost[p] = min(v + size - (p - q) + c for q, v in cost.items() if p - q <= size)
    return cost[place[-1]]


def test_plan_is_optimal():
    rng = random.Random(3)
    for _ in range(200):
        gaps = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 40))]
        place = np.cumsum(gaps)
        penalty = np.array([rng.choice([0, 2, 12]) for _ in gaps])
        cuts = packing.plan_cuts(place, penalty, 16)
        known = dict(zip(place.tolist(), penalty.tolist(), strict=True))
        last, total = 0, 0
        for c in cuts.tolist():
            assert c - last <= 16
            total += 16 - (c - last) + known[c]
            last = c
        assert last == place[-1]
        assert total == best_cost(place.tolist(), penalty.tolist(), 16)


def pieces_are_whole(rows, ids):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(ids)
    for k, v in ids.items():
        at = 0
        for r in sorted(by[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(v))
            assert r.ids_crc32 == zlib.crc32(np.array(v[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(v)
    padding = total = 0
    for v in sequences.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding, total


def test_packing_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    ids = {k: library["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids + [1] for k, t in docs.items()}
    padding, total = pieces_are_whole(queries.QUERIES["op6_packing"](spark, SF001).collect(), ids)
    assert padding < 0.03 * total


def test_packing_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 5000)
    rows = list(enumerate(texts(60)))
    ids = {k: library["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces_are_whole(packing.pack(with_clashes(spark, rows), path).collect(), ids)
    assert packing.pack(with_clashes(spark, []), path).count() == 0
    assert packing.pack(with_clashes(spark, [(1, "x"), (1, "x")]), path).count() == 2


@pytest.mark.parametrize("kind", ["random", "equal", "few", "one", "none", "steps", "text"])
def test_range_coder_round_trip(kind):
    rng = np.random.default_rng(2)
    ids = {"random": rng.integers(0, 65536, 9000), "equal": np.full(5000, 65535), "few": rng.integers(0, 3, 9000), "one": np.array([7]), "none": np.zeros(0, int),
           "steps": np.arange(9000) % 65536, "text": (rng.zipf(1.2, 200_000) % 49000)}[kind].astype(np.uint32)
    packed = rangecoder.pack_blocks(ids)
    assert len(packed) == -(-len(ids) // rangecoder.BLOCK_IDS)
    back = rangecoder.unpack_blocks(packed)
    assert np.array_equal(np.concatenate(back) if back else ids[:0], ids)
    if packed:  # every block is decoded alone
        assert np.array_equal(rangecoder.unpack_blocks(packed[-1:])[0], back[-1])


def test_carries_run_over_full_words():
    rng = np.random.default_rng(11)
    for seed in range(3):
        ids = (np.random.default_rng(seed).zipf(1.4, 4096 * 60) % 49000).astype(np.uint32)
        assert np.array_equal(np.concatenate(rangecoder.unpack_blocks(rangecoder.pack_blocks(ids))), ids)
    assert rng is not None


def test_damage_is_noticed():
    block = bytearray(rangecoder.pack_blocks(np.arange(3000, dtype=np.uint32))[0])
    block[40] ^= 1
    with pytest.raises(ValueError):
        rangecoder.unpack_blocks([bytes(block)])


def test_crc_join():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(0, 40)), rng.randbytes(rng.randrange(0, 40))
        assert tokenfile.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def file_is_right(rows, docs, tokenizer):
    start, want = 0, []
    for k, t in docs:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == sorted(want)


def test_token_file_query(spark, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    file_is_right(queries.QUERIES["op2_token_file"](spark, SF001).collect(), docs, library["word_bpe_49k.json"])


def test_token_file_odd_texts(spark, library, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(rangecoder, "BLOCK_IDS", 4096)
    rows = list(enumerate([*texts(60), "long words " * 6000]))
    blocks = tokenfile.write(with_clashes(spark, rows), path)
    file_is_right(tokenfile.read(blocks.repartition(3)).collect(), rows, library["word_bpe_49k.json"])
    assert tokenfile.read(tokenfile.write(with_clashes(spark, []), path)).count() == 0
    assert [tuple(r) for r in tokenfile.read(tokenfile.write(with_clashes(spark, [(3, None), (3, None)]), path)).orderBy("start").collect()] == [
        (3, k, 1, zlib.crc32(b"\1\0\0\0")) for k in (0, 1)]


def test_workers_give_memory_back(monkeypatch):
    """A packing task loads no second copy of the vocabulary, and what a task has freed doesn't stay with the worker."""
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens.library_encoder(path)
    loads, real = [], tokenizers.Tokenizer.from_file
    monkeypatch.setattr(tokenizers, "Tokenizer", type("T", (), {"from_file": staticmethod(lambda p: loads.append(p) or real(p))}))
    ends = packing.sentence_ends(path)
    assert not loads and ends[real(path).token_to_id(".")] and not ends[real(path).token_to_id("a")]

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        held = [np.ones(60_000, np.uint8) for _ in range(3_000)]   # 180 MB in pieces of the heap
        last = held.pop()
        del held
        yield from batches
        assert last[0]

    before = resident()
    assert list(common.lean(run)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 40 << 20
