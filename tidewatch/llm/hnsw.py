"""Embedding near-dedup with hierarchical navigable small-world graphs over the leaders of regions.

The vectors with the same label (and length) are dealt to regions: about sqrt(n) / 16 of them are
leaders, and a vector's home is the region of its nearest leader.  One graph per label holds the leaders;
it is built once and finds, for each vector, all leaders that are nearly as near as its own.  A beam that
is full of such leaders is widened until it reaches below them, and an audit compares some of each
block's queries with brute force: as long as it finds a missing leader, the whole block is searched
again with twice the beam, in the end with all leaders.

A vector visits each region whose border is at most half a link's length away from it.  Of two linked vectors
with different homes at least one lies so near to the border between their leaders, so no
link is lost by that, and most pairs of regions of most vectors are never looked at.  A link that both regions see
counts in the one with the smaller number.

Visits are made first with sketches of 16 dimensions: a visitor whose sketch is farther from the residents' than a link is
long has no link there, and only the others take their whole vector along.

In its region, a vector is compared with the residents, in blocks of at most about ``SHARD`` rows and tiles
of ``TILE`` pairs: in single precision, and those near the threshold as cosines of the original vectors in
double precision.  A task counts the links of each vector and reduces them to a spanning forest tile by tile, so
that no table of pairs arises, however large a group is; components are then joined over all blocks.

A vector that is null, empty or zero, or holds null or non-finite components, links with nothing, as
does one without label.  Each row is a vector of its own: rows with the same id, also equal ones,
are compared like others, and n_links counts rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.plan import sieved
from .common import components, written

#: Rows of a block, about, and pairs of a tile.
SHARD, TILE = 65_536, 1 << 22
#: A label of n vectors has about sqrt(n) / SPACING leaders: more of them make regions smaller, and more visits.
SPACING = 16
#: Dimensions of a sketch, and how far its rounding can move two of them apart.
SKETCH, ROUNDING = 16, 1.1e-3
FORWARD, LINKS, UPPER = 16, 32, 16   # chosen and total neighbours on the lowest level, and above
BUILD_BEAM, BEAM, BATCH = 48, 48, 256
AUDITED = 64


def _search(x: np.ndarray, neighbours: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all rows of ``q`` in step.  ``x`` and ``neighbours`` have one more row for
    "none" (the last index).  Returns indices and inner products, best first."""
    n, m = len(x) - 1, len(q)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True
    rows = np.arange(m)[:, None]
    near = np.full((m, beam), n)
    value = np.full((m, beam), -np.inf, np.float32)
    waits = np.zeros((m, beam), bool)
    fresh = entry
    active = np.arange(m)
    while True:
        fresh = np.sort(fresh, axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n
        fresh[seen[active[:, None], fresh]] = n
        seen[active[:, None], fresh] = True
        got = np.einsum("qmd,qd->qm", x[fresh], q[active])
        got[fresh == n] = -np.inf
        ids = np.concatenate([near[active], fresh], axis=1)
        values = np.concatenate([value[active], got], axis=1)
        open_ = np.concatenate([waits[active], fresh < n], axis=1)
        best = np.argpartition(-values, beam - 1, axis=1)[:, :beam] if values.shape[1] > beam else np.arange(values.shape[1])[None, :].repeat(len(active), 0)
        at = np.arange(len(active))[:, None]
        near[active], value[active], waits[active] = ids[at, best], values[at, best], open_[at, best] & (ids[at, best] < n)
        active = np.flatnonzero(waits.any(1))
        if not len(active):
            break
        turn = np.where(waits[active], value[active], -np.inf)
        k = min(wide, beam)
        pick = np.argpartition(-turn, k - 1, axis=1)[:, :k]
        at = active[:, None]
        node = np.where(waits[at, pick], near[at, pick], n)
        waits[at, pick] = False
        fresh = neighbours[node].reshape(len(active), -1).astype(np.int64)
    order = np.argsort(-value, axis=1, kind="stable")
    return near[rows, order], value[rows, order]


def _choose(x: np.ndarray, ids: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row: first those nearer to it than to any chosen one, then the nearest of the rest."""
    none = len(x) - 1
    between = np.einsum("qcd,qed->qce", x[ids], x[ids])
    kept = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        rival = np.where(kept, between[:, c], -np.inf).max(1)
        kept[:, c] = (ids[:, c] < none) & (rival < value[:, c]) & (kept.sum(1) < most)
    rank = np.where(ids == none, 3, np.where(kept, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1)


class Graph:
    """A navigable small-world graph over unit vectors, built in batches that double."""

    def __init__(self, unit: np.ndarray, seed: int = 1):
        n = len(unit)
        self.x = np.concatenate([unit, np.zeros((1, unit.shape[1]))]).astype(np.float32)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(UPPER)).astype(int), 6)
        order = rng.permutation(n)
        top = int(level.max(initial=0))
        order = np.r_[order[np.argmax(level[order])], order[np.arange(n) != np.argmax(level[order])]] if n else order
        self.levels = [np.full((n + 1, LINKS if k == 0 else UPPER), n, np.int32) for k in range(top + 1)]
        self.entry = int(order[0]) if n else 0
        done = 1
        while done < n:
            new = order[done:done + min(BATCH, done)]
            self._add(new, level)
            done += len(new)

    def _add(self, new: np.ndarray, level: np.ndarray) -> None:
        x, none = self.x, len(self.x) - 1
        q = x[new]
        entry = np.full((len(new), 1), self.entry)
        within = q @ q.T
        np.fill_diagonal(within, -np.inf)
        found = []
        for k in range(len(self.levels) - 1, -1, -1):
            ids, value = _search(x, self.levels[k], entry, q, BUILD_BEAM if k == 0 else 12)
            found.append((k, ids, value))
            entry = ids[:, :4]
        for k, ids, value in found:
            own = np.flatnonzero(level[new] >= k)
            if not len(own):
                continue
            m = min(FORWARD, len(own))
            mates = within[np.ix_(own, own)]
            pick = np.argpartition(-mates, m - 1, axis=1)[:, :m]
            mate_value = np.take_along_axis(mates, pick, 1)
            mate_ids = np.where(np.isfinite(mate_value), new[own][pick], none)
            ids, value = np.concatenate([ids[own], mate_ids], axis=1), np.concatenate([value[own], mate_value], axis=1)
            value[ids == none] = -np.inf
            best = np.argsort(-value, axis=1, kind="stable")[:, :BUILD_BEAM]
            chosen = _choose(x, np.take_along_axis(ids, best, 1), np.take_along_axis(value, best, 1), FORWARD if k == 0 else UPPER // 2)
            table = self.levels[k]
            table[new[own], :chosen.shape[1]] = chosen
            self._back(table, new[own], chosen)

    def _back(self, table: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
        """Links back; a full node gives up its farthest neighbour beyond the chosen ones for a nearer one."""
        x, none = self.x, len(self.x) - 1
        for i, mates in zip(new.tolist(), chosen, strict=True):
            mates = mates[mates < none]
            if not len(mates):
                continue
            rows = table[mates]
            free = rows == none
            has = free.any(1)
            slot = free.argmax(1)
            if not has.all():
                half = table.shape[1] // 2
                full = np.flatnonzero(~has)
                rest = rows[full][:, half:]
                value = np.einsum("rmd,rd->rm", x[rest], x[mates[full]])
                worst = value.argmin(1)
                slot[full] = worst + half
                has[full] = value[np.arange(len(full)), worst] < x[mates[full]] @ x[i]
            known = (rows == i).any(1)
            ok = has & ~known
            table[mates[ok], slot[ok]] = i

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(q), 1), self.entry)
        for k in range(len(self.levels) - 1, 0, -1):
            entry = _search(self.x, self.levels[k], entry, q, 12)[0][:, :4]
        return _search(self.x, self.levels[0], entry, q, min(beam, max(len(self.x) - 1, 1)))


def links(graph: Graph, unit: np.ndarray, q: np.ndarray, least: float, beam: int = BEAM, below_best: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) indices with an inner product of at least ``least`` (double precision), or, ``below_best``, of at
    least that of the query's best vector less ``least``.

    The audit takes evenly spaced queries of the block, whatever their number of links; below the best, each has one."""
    n = len(unit)
    if not n or not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def limit(value: np.ndarray) -> np.ndarray | float:
        return value.max(1, keepdims=True) - least if below_best else least

    sample = np.unique(np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int))
    truth = [np.flatnonzero(s >= limit(s[None])[0] if below_best else s >= least) for s in (unit @ v for v in q[sample])]
    q32 = q.astype(np.float32)
    while True:
        out_a, out_b = [], []
        todo, width = np.arange(len(q)), beam
        while len(todo):
            again = []
            if width > beam and width * 8 >= n:  # so wide a beam is no cheaper than one that holds all vectors
                for k in range(0, len(todo), BATCH):
                    value = q[todo[k:k + BATCH]] @ unit.T
                    r, c = np.nonzero(value >= limit(value))
                    out_a.append(todo[k:k + BATCH][r])
                    out_b.append(c)
                break
            step = max(8, min(BATCH, (64 << 20) // (n + 64 * width)))
            for k in range(0, len(todo), step):
                own = todo[k:k + step]
                ids, value = graph.search(q32[own], width)
                # single precision is off by less than 1e-5
                low = limit(value) - 1e-5
                full = (value[:, -1:] >= low)[:, 0] & (ids.shape[1] < n)
                again.append(own[full])
                r, c = np.nonzero((value >= low) & (ids < n) & ~full[:, None])
                a, b = own[r], ids[r, c]
                if not below_best:  # there, somewhat more is no harm
                    exact = np.einsum("pd,pd->p", q[a], unit[b]) >= least if len(a) < 200_000 else np.concatenate(
                        [np.einsum("pd,pd->p", q[a[s:s + 200_000]], unit[b[s:s + 200_000]]) >= least for s in range(0, len(a), 200_000)])
                    a, b = a[exact], b[exact]
                out_a.append(a)
                out_b.append(b)
            todo, width = np.concatenate(again), width * 4
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if beam >= n:
            return a, b
        key = a * n + b
        key.sort()
        wanted = np.concatenate([s * n + t for s, t in zip(sample, truth, strict=True)])
        at = np.searchsorted(key, wanted)
        missing = (at >= len(key)) | (key[np.minimum(at, len(key) - 1)] != wanted) if len(key) else np.ones(len(wanted), bool)
        if not missing.any():
            return a, b
        beam *= 2


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _usable(embedding: str):
    e = F.col(embedding)
    ok = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(e) > 0) & ok & F.exists(e, lambda v: v != 0), F.lit(False))


def _units(raw: np.ndarray) -> np.ndarray:
    v = raw.astype(float)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.sqrt(np.square(v).sum(1, keepdims=True))


def regions_of(graph: Graph, leaders: np.ndarray, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, region): each query's home comes first, then the regions that it visits."""
    reach = np.sqrt(max(0.0, 2 - 2 * least))  # the longest link
    # leaders are two apart at most
    at, to = links(graph, leaders, q, reach, below_best=True)
    value = np.concatenate([np.einsum("pd,pd->p", q[at[s:s + 200_000]], leaders[to[s:s + 200_000]]) for s in range(0, len(at), 200_000)])
    order = np.lexsort((to, -value, at))
    at, to, value = at[order], to[order], value[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    home, best = to[first][at], value[first][at]  # each query has a nearest leader
    apart = np.concatenate([np.linalg.norm(leaders[home[s:s + 200_000]] - leaders[to[s:s + 200_000]], axis=1) for s in range(0, len(at), 200_000)])
    near_border = (to == home) | (best - value <= reach / 2 * apart + 1e-9)
    return at[near_border], to[near_border]


def sketch(unit: np.ndarray) -> np.ndarray:
    """Coordinates in a few orthogonal directions: two sketches are no farther apart than the vectors, but for rounding."""
    d = unit.shape[1]
    directions = np.eye(d) if d <= SKETCH else np.linalg.qr(np.random.default_rng(d).normal(size=(d, SKETCH)))[0]
    return (unit @ directions).astype(np.float16)


def callers(residents: np.ndarray, visitors: np.ndarray, least: float) -> np.ndarray:
    """Of each visitor's sketch, whether it is so near to a resident's that there may be a link."""
    near = np.zeros(len(visitors), bool)
    if not len(residents):
        return near
    r, v = residents.astype(np.float32), visitors.astype(np.float32)
    most = np.float32((np.sqrt(max(0.0, 2 - 2 * least)) + ROUNDING) ** 2 + 1e-5)
    square, side = np.square(r).sum(1), np.ascontiguousarray(r.T) * 2
    step = max(1, TILE // len(r))
    for s in range(0, len(v), step):
        own = v[s:s + step]
        near[s:s + step] = np.square(own).sum(1) - (own @ side - square).max(1) <= most
    return near


class Block:
    """Some rows of a region: residents, and visitors from other regions."""

    def __init__(self, region: int, ids: np.ndarray, raw: np.ndarray, sizes: np.ndarray, regions: np.ndarray):
        self.region, self.ids, self.raw, self.sizes, self.regions = region, ids, raw, sizes, regions
        self.single = _units(raw).astype(np.float32)
        starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(int)
        self.home = regions[starts]
        self.residents, self.visitors = np.flatnonzero(self.home == region), np.flatnonzero(self.home != region)
        self.known = np.sort(np.repeat(np.arange(len(ids)), sizes) << 32 | regions)
        self.degree = np.zeros(len(ids), np.int64)

    def knows(self, rows: np.ndarray, regions: np.ndarray) -> np.ndarray:
        """Whether row i is dealt to region j too, for all of both."""
        few, which = np.unique(regions, return_inverse=True)
        key = rows[:, None] << 32 | few[None, :]
        at = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
        return (self.known[at] == key)[:, which]


class Forest:
    """Disjoint sets of nodes; a set's root is its smallest node."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, nodes: np.ndarray) -> np.ndarray:
        r = self.up[nodes]
        while (self.up[r] != r).any():
            r = self.up[r]
        self.up[nodes] = r
        return r

    def join(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        """Joins a[i] and b[j] wherever ``linked``."""
        while True:
            ra, rb = self.root(a), self.root(b)
            apart = linked & (ra[:, None] != rb[None, :])
            rows, cols = np.flatnonzero(apart.any(1)), np.flatnonzero(apart.any(0))
            if not len(rows):
                return
            # one link of each row and of each column; what is still apart then has another turn
            one, two = np.r_[ra[rows], ra[apart[:, cols].argmax(0)]], np.r_[rb[apart[rows].argmax(1)], rb[cols]]
            nodes, where = np.unique(np.r_[one, two], return_inverse=True)
            self.up[nodes] = nodes[_forest(where[:len(one)], where[len(one):], len(nodes))]


def compare(x: Block, y: Block, least: float) -> Forest:
    """Adds the links between residents, and residents and visitors, of two blocks of a region to the blocks' degrees; the blocks
    may be the same.  Nodes of the forest are the rows of ``x``, then those of ``y``."""
    same = x is y
    off = 0 if same else len(x.ids)
    forest = Forest(off + len(y.ids))
    slack = max(1e-5, (x.raw.shape[1] + 4) * 1.2e-7)  # how far single precision is off at most
    parts = [(x.residents, y.residents), (x.residents, y.visitors)] + ([] if same else [(x.visitors, y.residents)])
    for rows, cols in parts:
        if not len(rows) or not len(cols):
            continue
        within = same and rows is cols
        side = np.ascontiguousarray(y.single[cols].T)
        step = max(1, TILE // len(cols))
        for s in range(0, len(rows), step):
            own = rows[s:s + step]
            value = x.single[own] @ side
            linked = value >= least - slack
            if within:
                linked[np.arange(len(own)), s + np.arange(len(own))] = False
            r, c = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            if not len(r):
                continue
            linked, value = linked[np.ix_(r, c)], value[np.ix_(r, c)]
            a, b = own[r], cols[c]
            i, j = np.nonzero(linked & (value < least + slack))
            for t in range(0, len(i), 100_000):
                p, q = i[t:t + 100_000], j[t:t + 100_000]
                linked[p, q] = np.einsum("pd,pd->p", _units(x.raw[a[p]]), _units(y.raw[b[q]])) >= least
            # what a region with a smaller number sees counts there
            if rows is x.residents and cols is y.visitors:
                linked &= ~(x.knows(a, y.home[b]) & (y.home[b] < x.region)[None, :])
            elif rows is x.visitors:
                linked &= ~(y.knows(b, x.home[a]).T & (x.home[a] < y.region)[:, None])
            x.degree[a] += linked.sum(1)
            if not within:
                y.degree[b] += linked.sum(0)
            forest.join(a, b + off, linked)
    return forest


def _found(x: Block, y: Block, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, a row that stands for its tree, and number of links of each row with links."""
    forest = compare(x, y, least)
    ids, degree = (x.ids, x.degree) if x is y else (np.r_[x.ids, y.ids], np.r_[x.degree, y.degree])
    some = np.flatnonzero(degree)
    return ids[some], ids[forest.root(some)], degree[some]


def _leaders(use: DataFrame, shard: int, least: float) -> dict:
    """(label, length) -> graph and unit vectors of the leaders, of labels that have several.  They are picked by a hash of the
    vector, so that copies of one vector are one leader."""
    counted = (use.groupBy("label", "size").agg(F.count("*").alias("c"))
               .withColumn("wanted", F.greatest(F.ceil(F.col("c") / shard), F.floor(F.sqrt("c") / SPACING))).where("wanted > 1"))
    picked = (use.join(F.broadcast(counted), ["label", "size"])
              .where(F.pmod(F.xxhash64("v"), F.lit(1 << 40)) < F.col("wanted") / F.col("c") * (1 << 40))
              .select("label", "size", "v").distinct())
    out: dict = {}
    for r in picked.collect():
        out.setdefault((r["label"], r["size"]), []).append(r["v"])
    made = {}
    for k, v in out.items():
        unit = _units(np.array(sorted(v)))
        made[k] = (Graph(unit), unit)
    return {k: v for k, v in made.items() if len(v[1]) > 1}


def near(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = 0.98, shard: int = SHARD) -> DataFrame:
    """(key, n_links, component_id, kept) of each row; component_id is the smallest key that links reach."""
    element = getattr(vectors.schema[embedding].dataType, "elementType", None)
    short = element is not None and element.simpleString() == "float"
    source = (vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<float>" if short else "array<double>").alias("v"), F.col(label).alias("label"))
              .withColumn("v", F.when(_usable("v") & F.col("label").isNotNull(), F.col("v"))).withColumn("size", F.size("v")))
    leaders = _leaders(source.where("v is not null"), shard, least)
    kind, item = source.schema["label"].dataType.simpleString(), np.dtype(np.float32 if short else float)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, size = batch.column("v"), batch.column("size")
            length = np.where(v.is_valid().to_numpy(zero_copy_only=False), size.to_numpy(zero_copy_only=False), 0).astype(np.int64)
            flat = np.ascontiguousarray(v.flatten().to_numpy(zero_copy_only=False), item)
            start = np.r_[0, np.cumsum(length)]
            code = batch.column("label").dictionary_encode()
            names, codes = code.dictionary.to_pylist(), code.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            at, to, routed = [np.flatnonzero(length)], [np.zeros(np.count_nonzero(length), np.int64)], []
            for k, name in enumerate(names):
                for d in np.unique(length[(codes == k) & (length > 0)]).tolist():
                    if (name, d) in leaders:
                        rows = np.flatnonzero((codes == k) & (length == d))
                        units = _units(flat[start[rows][:, None] + np.arange(d)])
                        q, region = regions_of(*leaders[name, d], units, least)
                        routed.append((rows, units))
                        at[0], to[0] = at[0][~np.isin(at[0], rows)], to[0][:-len(rows)]
                        at.append(rows[q])
                        to.append(region)
            at, to = np.concatenate(at), np.concatenate(to)
            order = np.argsort(at, kind="stable")
            drawn = [None] * batch.num_rows  # of vectors that visit regions, or may be visited
            for rows, units in routed:
                drawn_here = sketch(units)
                for i, row in enumerate(rows.tolist()):
                    drawn[row] = drawn_here[i].tobytes()
            ends = np.r_[0, np.cumsum(np.bincount(at, minlength=batch.num_rows))].astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((start * item.itemsize).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), size, pa.ListArray.from_arrays(pa.array(ends), pa.array(to[order].astype(np.int32))),
                                              pa.array(drawn, pa.binary()), binary], ["key", "label", "size", "regions", "sketch", "v"])

    # written once, as rows need numbers that stay
    rows = written(source.mapInArrow(route, f"key {source.schema['key'].dataType.simpleString()}, label {kind}, size int, regions array<int>, sketch binary, v binary")
                   .withColumn("row", F.monotonically_increasing_id()), "vectors")
    cell = ["label", "size", "region"]
    visits = (rows.select("label", "size", "row", "sketch", F.posexplode("regions").alias("visitor", "region"))
              .withColumn("visitor", F.col("visitor") > 0))

    def large(rows: DataFrame, counts: dict) -> DataFrame:
        """Regions of more than ``shard`` rows, which are few, and the numbers of their parts."""
        counted = rows.groupBy(cell).agg(*(c.alias(n) for n, c in counts.items()))
        return F.broadcast(counted.where(F.array_max(F.array(*counts)) > shard).select(*cell, *(F.greatest(F.ceil(F.col(n) / shard), F.lit(1)).cast("int").alias(n) for n in counts)))

    # each part of a region's visitors meets each part of its residents
    met = visits.join(large(visits, {"i": F.count_if(~F.col("visitor")), "j": F.count_if("visitor")}), cell, "left")
    part = lambda n: F.array(F.pmod(F.xxhash64("row"), F.coalesce(n, F.lit(1))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    met = (met.where("sketch is not null").withColumn("i_", F.explode(F.when(F.col("visitor"), every("i")).otherwise(part("i"))))
           .withColumn("j_", F.explode(F.when(F.col("visitor"), part("j")).otherwise(every("j")))))

    def meet(group: pa.Table) -> pa.Table:
        visitor = group.column("visitor").to_numpy()
        raw = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.float16).reshape(len(visitor), -1)
        found = group.filter(pa.array(visitor)).filter(pa.array(callers(raw[~visitor], raw[visitor], least)))
        return found.select(["row", "region"])

    wanted = written(met.select(*cell, "i_", "j_", "row", "visitor", "sketch").groupBy(*cell, "i_", "j_").applyInArrow(meet, "row bigint, region int"), "wanted")
    with_visits = wanted.groupBy("row").agg(F.collect_set("region").alias("others"))
    body = rows.where(F.size("regions") > 0).select("label", "size", "row", F.get("regions", F.lit(0)).alias("home"), "v")
    home, away = (sieved(body, F.xxhash64("row"), wanted, F.xxhash64("row"), inside) for inside in (False, True))
    body = (home.withColumn("regions", F.array("home"))
            .unionByName(away.join(with_visits, "row", "left")
                         .withColumn("regions", F.concat(F.array("home"), F.coalesce("others", F.array().cast("array<int>")))).drop("others")).drop("home"))
    of_cells = (rows.select("label", "size", F.get("regions", F.lit(0)).alias("region")).where("region is not null")
                .unionByName(wanted.join(rows.select("row", "label", "size"), "row").select(*cell)))
    dealt = (body.withColumn("region", F.explode("regions")).join(large(of_cells, {"shards": F.count("*")}), cell, "left")
             .withColumn("shards", F.coalesce("shards", F.lit(1)))
             .withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")))

    def unpack(region: int, size: int, ids: bytes, raw: bytes, sizes: bytes, regions: bytes) -> Block:
        return Block(region, np.frombuffer(ids, np.int64), np.frombuffer(raw, item).reshape(-1, size), np.frombuffer(sizes, np.int64), np.frombuffer(regions, np.int64))

    def within(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        lists = group.column("regions").combine_chunks()
        raw = b"".join(x.as_buffer().to_pybytes() for x in group.column("v"))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        regions = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        packed = (group.column("row").to_numpy().tobytes(), raw, sizes.tobytes(), regions.tobytes())
        block = unpack(group.column("region")[0].as_py(), group.column("size")[0].as_py(), *packed)
        a, b, n = _found(block, block, least)
        more = group.column("shards")[0].as_py() > 1  # the block meets the others of its region
        none = [None] * len(a)
        cells = {c: pa.concat_arrays([pa.nulls(len(a), group.schema.field(c).type), *group.column(c).slice(0, int(more)).chunks]) for c in ("label", "size", "region", "shard")}
        blobs = {c: pa.array(none + [p] * more, pa.binary()) for c, p in zip(PACKED, packed, strict=True)}
        links_ = {c: pa.array([*v.tolist()] + [None] * more, pa.int64()) for c, v in (("a", a), ("b", b), ("n", n))}
        return pa.table(links_ | cells | blobs)

    PACKED = ("ids", "vectors", "sizes", "regions")
    found = written(dealt.groupBy("label", "size", "region", "shard").applyInArrow(
        within, f"a bigint, b bigint, n bigint, label {kind}, size int, region int, shard int, " + ", ".join(f"{c} binary" for c in PACKED)), "found")
    blocks = found.where("ids is not null").drop("a", "b", "n")
    other = blocks.select("label", "size", "region", *(F.col(c).alias(f"{c}2") for c in ("shard", *PACKED)))
    # each row is a task's worth of comparing
    work = (blocks.join(other, ["label", "size", "region"]).where("shard < shard2")
            .select("size", "region", *PACKED, *(f"{c}2" for c in PACKED)).repartition(F.col("ids"), F.col("ids2")))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                size, region, *packed = (batch.column(k)[r].as_py() for k in range(batch.num_columns))
                a, b, n = _found(unpack(region, size, *packed[:4]), unpack(region, size, *packed[4:]), least)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    found = (found.where("a is not null").select("a", "b", "n")
             .unionByName(written(work.mapInArrow(across, "a bigint, b bigint, n bigint"), "across")))
    degrees = found.groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    parts = components(found).select(F.col("node").alias("row"), F.col("component_id").alias("part"))
    out = (rows.select("key", "row").join(degrees, "row", "left").join(parts, "row", "left")
           .withColumn("part", F.coalesce("part", "row")))
    least_key = out.groupBy("part").agg(F.min("key").alias("component_id"))
    return (out.join(least_key, "part").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
        (F.col("key") == F.col("component_id")).alias("kept")))
