"""Phrase mining against plain counting."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tidewatch.llm import collocations, queries

from ..conftest import SF001
from .conftest import CLASHES

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, least=10, longest=3, top=2000, contained=50):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: n for p, n in count.items() if 2 <= len(p) and n >= least}
        rows = []
        for p, n in found.items():
            if any(len(q) > len(p) and contained * n <= 100 * m and any(q[i:i + len(p)] == p for i in range(len(q))) for q, m in found.items()):
                continue
            score, k = min((1_000_000 * n * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -n, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, n, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -n, left, right, total[lang], -score))
    return sorted(out)


def result(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def odd_rows(seed=1, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "é", "É", " ", "x y", "of", "日本", "#", "-"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?!", " ; "]
    rows = [(rng.choice(["en", "de", None, "und", "", "x y"]), "".join(rng.choice(words[:3 + k % 10]) + rng.choice(ends) for _ in range(rng.randrange(0, 60)))) for k in range(n)]
    return rows + [("en", None), ("en", ""), (None, "  \n"), ("en", "again and again " * 40), *[("de", "same words here. Same words there")] * 25, ("zz", "once only")]


@pytest.mark.parametrize(("shards", "least", "longest"), [(3, 10, 3), (1, 4, 3), (4, 3, 4), (2, 10, 2)])
def test_counts_scores_and_ranks(spark, shards, least, longest):
    rows = odd_rows()
    table = spark.createDataFrame([(*r, *(1, 2, *"abcdefghi")) for r in rows], f"lang string, text string, {CLASHES.replace('label string', 'word string')}").repartition(5)
    assert result(collocations.mine(table, shards=shards, least=least, longest=longest)) == plain(rows, least, longest)


def test_only_the_best_are_kept_and_ties_end_by_phrase(spark):
    rows = [("en", f"w{k % 7}x v{k % 7}x.") for k in range(700)] + [("de", "b a, a b, B A, ä a, a ä")] * 10
    table = spark.createDataFrame(rows, "lang string, text string")
    assert result(collocations.mine(table, top=3)) == plain(rows, top=3)


def test_slots_shared_by_phrases_change_nothing(spark):
    rows = odd_rows(3)
    table = spark.createDataFrame(rows, "lang string, text string")
    assert result(collocations.mine(table, slots=0, held=500)) == plain(rows)  # as many slots as buckets, many small posts


def test_large_counts_are_exact(spark):
    rows = [("en", "very often " * 30_000)] + [("en", "very rarely. ")] * 10
    assert result(collocations.mine(spark.createDataFrame(rows, "lang string, text string"))) == plain(rows)


def test_blocks_are_read_back():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(collocations._sums(collocations._deltas(keys), len(keys)), keys)
    assert len(collocations._unpacked(collocations._packed(keys[:0]), 0)) == 0


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_query_and_sql(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    have = result(queries.QUERIES["op11_collocations"](spark, SF001))
    assert have == plain(rows)
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{SF001}/documents.parquet'")
        assert sorted(db.execute(f"select {', '.join(COLUMNS)} from ({collocations.ORACLE_SQL})").fetchall()) == have
