"""The tokenization automaton against the tokenizers library and a plain merge loop."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import automaton, queries

from ..conftest import SF001
from .conftest import with_clashes
from .test_tokens import texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LITERALS = ["  <|endoftext|>  x", "<|endof", "text|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "\t<|endoftext|>\n\n", "<|endoftext|>", "x <|endoftext|>é"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain_merges(word, merges):
    """Every merge in order, each from left to right."""
    out = list(word)
    for u, v, w in merges:
        k = 0
        while k + 1 < len(out):
            if out[k] == u and out[k + 1] == v:
                out[k:k + 2] = [w]
            k += 1
    return out


def test_small_vocabularies_equal_plain_merges():
    rng = random.Random(1)
    for _ in range(60):
        letters = [b"a", b"b", b"c"][:rng.randrange(1, 4)]
        tokens, merges = dict(enumerate(letters)), []
        for _ in range(rng.randrange(0, 14)):
            u, v = rng.choice(list(tokens)), rng.choice(list(tokens))
            made = tokens[u] + tokens[v]
            if made not in tokens.values():
                merges.append((u, v, len(tokens)))
                tokens[len(tokens)] = made
        a = automaton.Automaton(tokens, merges)
        for _ in range(120):
            word = bytes(rng.choice(b"abc"[:len(letters)]) for _ in range(rng.randrange(1, 24)))
            ids = plain_merges([letters.index(bytes([b])) for b in word], merges)
            assert a.encode_word(word) == ids
            assert all(a.follows(x, y) for x, y in zip(ids[:-1], ids[1:], strict=True))


def test_paths_are_exactly_the_encodings():
    tokens = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab", 5: b"aaaa"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (2, 2, 5)]
    a = automaton.Automaton(tokens, merges)
    for x in tokens:
        for y in tokens:
            letters = [b"ab".index(c) for c in tokens[x] + tokens[y]]
            assert (a.made[x] >= 0 and a.follows(x, y)) == (plain_merges(letters, merges) == [x, y])


def test_two_merges_for_a_token_are_refused():
    with pytest.raises(ValueError):
        automaton.Automaton({0: b"a", 1: b"aa", 2: b"aaa"}, [(0, 0, 1), (1, 0, 2), (0, 1, 2)])


def test_long_words():
    a = automaton.vocabulary(PATH).automaton
    rng = random.Random(3)
    for word in (b"a" * 200_000, bytes(rng.choice(b"abcdefgh") for _ in range(100_000)), "日本語".encode() * 20_000):
        assert b"".join(a.tokens[i] for i in a.encode_word(word)) == word


def test_table_equals_the_library(spark, library):
    rows = list(enumerate([*texts(1500), *LITERALS]))
    out = {r.doc_id: r for r in automaton.encode(with_clashes(spark, rows), PATH, columns=("ids", "decoded")).collect()}
    for k, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (out[k].ids, out[k].decoded) == (ids, library.decode(ids, skip_special_tokens=False))


def test_any_ids_are_decoded(spark, library):
    rng = random.Random(7)
    rows = [(k, [rng.randrange(50257) for _ in range(rng.randrange(0, 9))]) for k in range(300)] + [(300, None)]
    out = {r.doc_id: r.text for r in automaton.decode(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"), PATH).collect()}
    assert out == {k: library.decode(v or [], skip_special_tokens=False) for k, v in rows}


def test_empty_table_and_repeated_rows(spark):
    assert automaton.encode(with_clashes(spark, []), PATH).count() == 0
    out = automaton.encode(with_clashes(spark, [(1, "hello world"), (1, "hello world"), (None, None)]), PATH, columns=("n_tokens",)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 0), (1, 2), (1, 2)]


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = queries.QUERIES["op13_automaton"](spark, SF001).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
