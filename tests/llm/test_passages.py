"""Paragraph dedup against brute force."""

import random

import pytest

from tidewatch.llm import passages, queries

from ..conftest import SF001, SF01
from .conftest import with_clashes
from .test_setjoin import shingles


def brute(rows, least=passages.MIN_WORDS):
    """{(key, line): (first key, removed)} by comparing all paragraphs."""
    spots = [(k, j, shingles(x)) for k, t in rows for j, x in enumerate((t or "").split("\n")) if len(x.split()) >= least]
    spots.sort(key=lambda s: (s[0], s[1]))
    parent = list(range(len(spots)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    by = {}
    for i, (_, _, s) in enumerate(spots):
        met = {}
        for x in s:
            for j in by.setdefault(x, []):
                met[j] = met.get(j, 0) + 1
            by[x].append(i)
        for j, c in met.items():
            if 100 * c >= 80 * (len(s) + len(spots[j][2]) - c):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(spots)):
        groups.setdefault(find(i), []).append(i)
    return {spots[i][:2]: (spots[g[0]][0], i != g[0]) for g in groups.values() if len(g) > 1 for i in g}


def got(df):
    return {(r.doc_id, r.line): (r.first_key, r.removed) for r in df.collect()}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, have = brute(rows), got(passages.repeats(docs))
    missed = set(want) - set(have)
    assert not set(have) - set(want)
    assert len(missed) <= 0.002 * len(want)      # the bands' recall is 0.999 at the threshold
    out = queries.QUERIES["op7_passages"](spark, sf).collect()
    assert len(out) == len(rows)
    if not missed:
        assert have == want
        assert {(r.doc_id, j) for r in out for j in r.removed_lines} == {x for x, (_, gone) in want.items() if gone}


def made():
    rng = random.Random(8)
    para = [" ".join(f"v{rng.randrange(900)}" for _ in range(60)) for _ in range(12)]
    rows = []
    for i in range(80):
        own = [" ".join(f"o{rng.randrange(10**6)}" for _ in range(50))]
        for p in rng.sample(para, rng.randrange(0, 3)):
            w = p.split()
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = "changed"
            own.append(" ".join(w))
        own += ["short line"] * rng.randrange(0, 3)
        rng.shuffle(own)
        rows.append((i, "\n".join(own) + "\n" * rng.randrange(0, 2)))
    return [*rows, (900, None), (901, ""), (902, "\n\n"), (903, " ".join(["long"] * 30000)), (904, " ".join(["long"] * 30000))]


def test_cleaned(spark):
    rows = made()
    want = brute(rows)
    out = {r.doc_id: r for r in passages.cleaned(with_clashes(spark, rows)).collect()}
    assert len(out) == len(rows)
    for k, t in rows:
        expected = t if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if not want.get((k, j), (0, False))[1])
        assert out[k].text == expected
        assert out[k].sig == "s"


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, "other"), (None, text), (2, "x\n" + text)]
    out = sorted(((r.doc_id, r.n_removed) for r in passages.summary(with_clashes(spark, rows)).collect()), key=str)
    assert out == [(1, 0), (1, 1), (1, 1), (2, 1), (None, 0)]
    assert passages.summary(with_clashes(spark, [])).count() == 0


def test_bands_are_tuned():
    bands, rows = passages.tuned_bands(0.8)
    assert 1 - (1 - 0.8 ** rows) ** bands >= passages.RECALL


def shared_words(rows, n=passages.WINDOW):
    """{key: (positions of words in a window that another row has, those of them that go)}, all windows compared."""
    at = {}
    for k, t in rows:
        w = (t or "").lower().split()
        for i in range(len(w) - n + 1):
            at.setdefault(tuple(w[i:i + n]), set()).add((k, i))
    out = {k: (set(), set()) for k, _ in rows}
    for spots in at.values():
        first = min(k for k, _ in spots)
        for k, i in spots:
            if any(k != j for j, _ in spots):
                out[k][0].update(range(i, i + n))
                if k != first:
                    out[k][1].update(range(i, i + n))
    return out


def crossing():
    rng = random.Random(5)
    word = lambda: f"w\u00e9{rng.randrange(10**6)}"
    passage = [[word() for _ in range(rng.randrange(50, 90))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(0, 30))]
        for p in rng.sample(passage, rng.randrange(0, 3)):
            w += p[rng.randrange(0, 12):] + [word() for _ in range(rng.randrange(0, 60))]
        if i % 2:      # lines that all are too short for a paragraph
            rows.append((i, "".join(x + ("\n" if rng.random() < 0.15 or j % 30 == 29 else " ") for j, x in enumerate(w))))
        else:          # one line, in which a passage is a part
            rows.append((i, " ".join(w)))
    return [*rows, (900, None), (901, ""), (902, " ".join(["Long"] * 300))]


def words_of(text, spans):
    """Positions of words inside spans."""
    out, at = set(), 0
    for i, w in enumerate((text or "").split()):
        at = text.index(w, at)
        if any(s.start <= at and at + len(w) <= s.end for s in spans):
            out.add(i)
        at += len(w)
    return out


def test_runs_across_lines_equal_all_shared_windows(spark):
    rows = crossing()
    want = shared_words(rows)
    assert sum(len(gone) for _, gone in want.values()) > 1000
    docs = with_clashes(spark, rows)
    some = {r.doc_id: r for r in passages.summary(docs, least=10**6).collect()}
    for k, t in rows:
        assert (words_of(t, some[k].repeated_spans), words_of(t, some[k].removed_spans)) == want[k]
    out = {r.doc_id: r.text for r in passages.cleaned(docs, least=10**6).collect()}
    for k, t in rows:
        assert (out[k] or "").split() == [w for i, w in enumerate((t or "").split()) if i not in want[k][1]]
    out = [(r.doc_id, r.text) for r in passages.cleaned(docs).collect()]
    assert not any(gone for _, gone in shared_words(out).values())


def test_all_shared_windows_of_a_table(spark):
    rows = [(r.doc_id, r.text) for r in passages.cleaned(spark.read.parquet(f"{SF001}/documents.parquet"), window=10**6).select("doc_id", "text").collect()]
    want = shared_words(rows)
    have = {r.doc_id: r for r in passages.summary(spark.createDataFrame(rows, "doc_id bigint, text string"), least=10**6).collect()}
    for k, t in rows:
        assert len(words_of(t, have[k].removed_spans)) == len(want[k][1])


def test_sieve_keeps_every_row_that_a_join_could_find(spark):
    from pyspark.sql import functions as F

    from tidewatch.llm.common import sifted
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("text").alias("text"))
    side = spark.range(0, 20_000, 7).select(F.when(F.col("id") > 0, F.col("id")).alias("s"))
    out = sifted(rows, F.xxhash64("k"), side, F.xxhash64("s"))
    near = {r.k for r in out.where("_near").collect()}
    assert out.columns == ["k", "text", "_near"] and out.count() == 20_000
    assert near >= {r.s for r in side.collect()} and len(near) < 3_100
    assert sifted(rows, F.xxhash64("k"), side.limit(0), F.xxhash64("s")).where("not _near").count() == 20_000


def test_only_rows_that_may_repeat_are_joined_with_their_texts(spark):
    from pyspark.sql import functions as F

    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), "id").alias("text"))
    gone = spark.createDataFrame([(1, 1, [0])], "_key bigint, _hash bigint, _gone array<int>")
    seen = []
    real = passages.sifted
    passages.sifted = lambda rows, *a: seen.append(rows.columns) or real(rows, *a)
    try:
        assert passages.shared(docs, gone).count() == 0
    finally:
        passages.sifted = real
    assert [("text" in c) for c in seen] == [True, True]
