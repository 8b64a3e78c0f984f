"""N-gram Jaccard join against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import queries, setjoin
from tidewatch.llm.linking import _runs, packed, unpacked

from ..conftest import SF001, SF01
from .conftest import with_clashes


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(n, component) by row number; components by key."""
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows) if k is not None)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op9_jaccard_join"](spark, sf)) == brute(rows)


def family(seed=4):
    """Chains of edits, frequent passages, groups of copies and texts of few words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(4)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 70))]
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(base))
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    for _ in range(60):
        texts.append(" ".join(rng.sample(passage, 2)) + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))))
    for n in range(1, 9):
        texts += [" ".join(vocabulary[:n]), " ".join(vocabulary[:n]).upper(), "\t".join(vocabulary[:n]) + "\n"]
    texts += [None, "", " \n", passage[0], passage[0]] + ["same again and again and again"] * 40
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("often", [False, True])
def test_families(spark, often, monkeypatch):
    rows = list(enumerate(family()))
    if often:  # every counted shingle is of a frequent class: only combinations and uncounted ones are posted
        real = setjoin._counters
        monkeypatch.setattr(setjoin, "_counters", lambda m: real(m) * 40)
    assert got(setjoin.join(with_clashes(spark, rows))) == brute(rows)


def test_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text of exactly seven words"), (None, "a b c d e f"), (5, "A B c d e f"), (7, None), (7, None)]
    out = got(setjoin.join(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert out == [(1, 2, 1), (1, 2, 1), (1, 3, 1), (5, 2, 1), (7, 0, 7), (7, 0, 7)]


def test_empty_table(spark):
    assert setjoin.join(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_keep_first(spark):
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (4, "g h i j k l"), (5, None), (None, "x")]
    out = setjoin.keep_first(with_clashes(spark, rows))
    assert sorted(r.doc_id for r in out.where(F.col("doc_id").isNotNull()).collect()) == [2, 4, 5]
    assert out.where("doc_id is null").count() == 1


def test_keep_first_decides_by_row(spark):
    one, other = "a b c d e f", "g h i j k l"
    rows = [(1, one), (1, one), (1, "A b c d e f"), (2, one), (None, one), (None, other), (None, other), (3, "m n o p q r"), (3, one), (4, ""), (4, ""), (None, None)]
    out = [(r.doc_id, (r.text or "").lower()) for r in setjoin.keep_first(with_clashes(spark, rows)).collect()]
    assert sorted(out, key=str) == sorted([(1, one), (None, other), (3, "m n o p q r"), (4, ""), (4, ""), (None, "")], key=str)


def test_runs_do_not_depend_on_batches():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    base = {i: (rng.randrange(1, 40), rng.randrange(1, 5)) for i in range(50)}
    rows = sorted((rng.randrange(6), base[i][1], i, base[i][0]) for i in (rng.randrange(50) for _ in range(200)))

    def run(sizes):
        def batches():
            at = 0
            while at < len(rows):
                k = rng.choice(sizes)
                part = rows[at:at + k]
                at += k
                columns = [np.array([r[j] for r in part], np.int64) for j in (0, 1, 2)]
                n = np.array([r[3] for r in part], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, n << 32 | n)], ["sig", "kind", "id", "size"])
        return [tuple(r.values()) for b in _runs(batches()) for r in b.to_pylist()]
    assert sorted(run([1, 2, 3]), key=str) == sorted(run([1000]), key=str)


def test_only_texts_that_a_join_could_find_are_shuffled(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(300)] + [(900 + k, "one text that is here three times over") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    frame = type(docs)
    wide, real = [], frame.join

    def join(self, other, on=None, how=None):
        if "text" in self.columns and how == "left_semi":
            wide.append(self.count())
        return real(self, other, on, how)

    frame.join = join
    try:
        out = setjoin.keep_first(docs)
    finally:
        frame.join = real
    assert sorted(r.doc_id for r in out.collect()) == [*range(300), 900]
    assert wide and max(wide) <= 10   # 303 before


def test_texts_of_pairs_come_once_and_without_a_shuffle(spark, monkeypatch):
    """Rows that stand for their set aren't shuffled with their texts; repeated rows and null keys still come once."""
    copies = [" ".join([*(f"w{j}" for j in range(40)), f"end{k}"]) for k in range(40)]
    rows = list(enumerate(copies)) + [(3, copies[3])] * 5 + [(3, copies[4]), (3, ""), (None, copies[5]), (900, copies[6])]
    rows += [(None, " ".join([*(f"w{j}" for j in range(40)), "null"]))] * 3 + [(50, None), (None, None), (60, "quite another text of more words than five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    frame, asked, wide = type(docs), [], []
    real, real_link = frame.join, setjoin.link

    def join(self, other, on=None, how=None):
        if "text" in self.columns and how == "left_semi":
            wide.append(self.count())
        return real(self, other, on, how)

    def link(postings, texts_of, *rest):
        asked.append((texts_of, postings.select("id").distinct()))
        return real_link(postings, texts_of, *rest)

    monkeypatch.setattr(setjoin, "link", link)
    frame.join = join
    try:
        assert got(setjoin.join(docs)) == brute(rows)
        assert wide and max(wide) <= 10   # only the repeated rows and those that share a key with others; all 50 before
        texts_of, ids = asked[0]
        found = texts_of(ids).collect()
    finally:
        frame.join = real
    texts = unpacked(pa.array([r.text for r in found], pa.binary())).to_pylist()
    assert len({r.id for r in found}) == len(found) == 42
    assert sorted(texts) == sorted({t for _, t in rows if t})


def test_packed_texts_and_counters():
    texts = [None, "", "x", "ß\n" * 300, "word " * 5_000, "\0" * 511, "\0" * 512]
    assert unpacked(packed(pa.array(texts))).to_pylist() == ["", *texts[1:]]
    assert unpacked(packed(pa.array(texts, pa.large_string()).slice(2))).to_pylist() == texts[2:]
    counts = np.random.default_rng(5).poisson(0.2, setjoin.BLOCK).astype(np.uint32)
    counts[::999] = 4_000_000_000
    raw = setjoin._pack(counts)
    assert (setjoin._unpack(raw) == counts).all() and len(raw) < setjoin.BLOCK // 3   # 4 * BLOCK before
