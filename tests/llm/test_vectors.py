"""Inverted multi-index and small-world near-dedup against brute force."""

import numpy as np
import pytest

from tidewatch.llm import hnsw, multiindex, queries

from ..conftest import SF001

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, key bigint, v string, cell int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 5, "v", 3) for r in rows], SCHEMA)


def nearest(ids, x, every, k):
    out = {}
    for j in np.flatnonzero(ids % every == 0):
        s = np.einsum("nd,d->n", x, x[j])
        s[j] = -np.inf
        out[int(ids[j])] = [int(v) for v in ids[np.lexsort((ids, -s))[:min(k, len(ids) - 1)]]]
    return out


def test_search_query(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = nearest(ids, x, 20, 20)
    got = {}
    at = {int(i): k for k, i in enumerate(ids)}
    for r in queries.QUERIES["op3_multi_index"](spark, SF001).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(got[r.query_id])
        assert r.score == pytest.approx(float(x[at[r.query_id]] @ x[at[r.vec_id]]), rel=1e-12)
    assert set(got) == set(want)
    hits = [len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9


def odd_vectors():
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=6).tolist(), i % 2) for i in range(60)]
    near = [(100 + i, (np.ones(6) + rng.normal(size=6) * 0.001).tolist(), 1) for i in range(40)]
    odd = [(200, None, 1), (220, [], 1), (240, [0.0] * 6, 1), (260, [float("nan")] + [1.0] * 5, 1), (280, [float("inf")] + [1.0] * 5, 1),
           (300, [None] + [1.0] * 5, 1), (320, [1.0] * 6, None), (340, [1.0] * 6, 0), (341, [1.0] * 3, 1)]
    return good + near + odd


def usable(v, d=None):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and (d is None or len(v) == d)


def test_search_odd_vectors(spark):
    rows = odd_vectors()
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if usable(v, 6)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    want = nearest(ids, x, 20, 20)
    got = {}
    for r in multiindex.search(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(want)
    assert all(len(got[q]) == 20 for q in want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0], 1)], [(20, [1.0, 2.0], 1), (20, [1.0, 2.0], 1), (3, [2.0, 1.0], 1)], [(20, [0.0], 1)]])
def test_search_small(spark, rows):
    out = multiindex.search(frame(spark, rows)).collect()
    n = len([r for r in rows if usable(r[1])])
    assert len(out) == sum(n - 1 for r in rows if usable(r[1]) and r[0] % 20 == 0)


def test_search_lengths_slices_and_blocks(spark):
    """Two lengths, a hot cell in many slices, blocks of few queries: every candidate pair within a length is reached."""
    rng = np.random.default_rng(8)
    rows = [(i, (np.ones(6) + (rng.normal(size=6) if i % 3 else 0)).tolist(), 1) for i in range(200)] + [(i, rng.normal(size=3).tolist(), 1) for i in range(400, 440)]
    got = {}
    for r in multiindex.search(frame(spark, rows), target=1.0, slice_rows=16, block=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {}
    for d in (6, 3):
        some = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if len(v) == d]
        want |= nearest(np.array([i for i, _ in some]), np.array([v for _, v in some]), 20, 20)
    assert got == want


def links_of(rows, least=0.98):
    n = len(rows)
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if usable(v) else None for _, v, _ in rows]
    s = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                s[i, j] = unit[i] @ unit[j] >= least
    comp = np.array([r[0] for r in rows])
    while True:
        new = np.array([min([comp[i], *comp[s[i]]]) for i in range(n)])
        if (new == comp).all():
            return sorted((r[0], int(s[i].sum()), int(comp[i]), bool(comp[i] == r[0])) for i, r in enumerate(rows))
        comp = new


@pytest.mark.parametrize("shard", [hnsw.SHARD, 16])
def test_near_equals_brute_force(spark, shard):
    rows = odd_vectors() + [(500, [1.0] * 6, 1), (500, [1.0] * 6, 1)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near(frame(spark, rows), shard=shard).collect())
    assert got == links_of(rows)


def test_near_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in queries.QUERIES["op10_hnsw_dedup"](spark, SF001).collect())
    assert got == links_of(rows)


def test_near_empty(spark):
    assert hnsw.near(frame(spark, [])).count() == 0


def test_graph_finds_large_groups():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(5, 16))
    x = np.concatenate([c + rng.normal(size=(n, 16)) * 0.02 for c, n in zip(centre, (700, 60, 20, 3, 1), strict=True)] + [rng.normal(size=(600, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = hnsw.links(hnsw.Graph(x), x, x, 0.98)
    assert len(a) == int((x @ x.T >= 0.98).sum())
    assert (np.einsum("pd,pd->p", x[a], x[b]) >= 0.98).all()


def clustered(n, seed=3):
    """Scattered vectors, groups around borders, one large group of near copies and one of equal vectors."""
    rng = np.random.default_rng(seed)
    scattered = rng.normal(size=(n, 12))
    scattered /= np.linalg.norm(scattered, axis=1, keepdims=True)
    pairs = scattered[::3] + rng.normal(size=(len(scattered[::3]), 12)) * 0.055
    group = scattered[0] + rng.normal(size=(n // 4, 12)) * 0.04
    return np.concatenate([scattered, pairs, group, np.repeat(scattered[1:2], n // 8, axis=0)])


def brute(x, least=0.98):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T >= least
    np.fill_diagonal(s, False)
    comp = np.arange(len(x))
    while True:
        new = np.minimum(comp, np.where(s, comp[None, :], len(x)).min(1))
        if (new == comp).all():
            return s, comp
        comp = new


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_over_regions_and_blocks(spark, monkeypatch, kind):
    """Each label's graph is built once, and links within and between regions and blocks count once."""
    built = []
    graph = hnsw.Graph
    monkeypatch.setattr(hnsw, "Graph", lambda unit: built.append(len(unit)) or graph(unit))
    rows, want = [], []
    for label in (1, 2):
        x = clustered(400, label)
        if kind == "float":
            x = x.astype(np.float32).astype(float)
        s, comp = brute(x)
        rows += [(1000 * label + i, v.tolist(), label) for i, v in enumerate(x)]
        want += [(1000 * label + i, int(s[i].sum()), 1000 * label + int(comp[i]), bool(comp[i] == i)) for i in range(len(x))]
    made = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near(made, shard=60).collect())
    assert got == want
    assert len(built) == 2 and all(2 < n < 40 for n in built)


def test_regions_lose_no_link_and_are_few():
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.normal(size=(300, 16)) * 0.02 for c in rng.normal(size=(20, 16))])
    x = np.concatenate([x, rng.normal(size=(1500, 16)), clustered(300)[:, :1] + rng.normal(size=(1, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    leaders = x[rng.permutation(len(x))[:60]]
    at, to = hnsw.regions_of(hnsw.Graph(leaders), leaders, x, 0.98)
    first = np.r_[True, at[1:] != at[:-1]]
    home = to[first]
    assert (home == (x @ leaders.T).argmax(1)).mean() > 0.999
    dealt = np.zeros((len(x), 60), bool)
    dealt[at, to] = True
    a, b = np.nonzero(x @ x.T >= 0.98)
    assert (dealt[a, home[b]] | dealt[b, home[a]]).all()
    assert len(at) < 15 * len(x)


def test_compare_holds_no_table_of_pairs():
    """A block of near copies: 16 million links."""
    import tracemalloc

    rng = np.random.default_rng(7)
    raw = 1 + rng.normal(size=(4000, 8)) * 0.01
    block = hnsw.Block(0, np.arange(4000), raw, np.ones(4000, np.int64), np.zeros(4000, np.int64))
    tracemalloc.start()
    forest = hnsw.compare(block, block, 0.98)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (block.degree == 3999).all() and (forest.root(np.arange(4000)) == 0).all()
    assert peak < 200 << 20


@pytest.mark.parametrize("d", [5, 64])
def test_sketches_lose_no_visitor(d):
    rng = np.random.default_rng(d)
    residents = rng.normal(size=(700, d))
    near = residents[:200] + rng.normal(size=(200, d)) * np.linspace(0, 0.3, 200)[:, None]
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    residents, visitors = unit(residents), unit(np.concatenate([near, rng.normal(size=(500, d))]))
    linked = (visitors @ residents.T >= 0.98).any(1)
    called = hnsw.callers(hnsw.sketch(residents), hnsw.sketch(visitors), 0.98)
    assert linked.sum() > 50 and not (linked & ~called).any()
    if d > hnsw.SKETCH:
        assert hnsw.sketch(residents).shape[1] == hnsw.SKETCH and called[200:].sum() < 50
    assert not hnsw.callers(hnsw.sketch(residents)[:0], hnsw.sketch(visitors), 0.98).any()
