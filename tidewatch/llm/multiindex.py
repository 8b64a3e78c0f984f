"""Nearest neighbours by largest inner product with an inverted multi-index.

Vectors are cut into two halves and each half is quantised on its own; a pair of centroids is a cell
of the index, and every vector lies in one.  A query ranks the centroids of each half by their
distance (the negative inner product with its half) and walks the pairs in the order of their sums with
a heap, until the cells hold enough vectors.  These are reranked by their exact inner products.

The centroids are fitted on at most ``FIT_ROWS`` vectors (a sample by hash) and each vector is indexed;
a half has ``4 n^(1/4)`` centroids, so the cells grow with the square root of the table.  How many
entries are enough is measured: for up to ``AUDITED`` queries, exact neighbours come from one pass over
all vectors, and the walk goes on until it has met the given share of them; that count of entries, with
a margin, holds for all queries.  The cells of a query are then those up to the walk's last summed
distance, so a single number carries them to the tasks.

Left centroids are dealt to at most ``REGIONS`` regions of like size.  A region is cut into slices of
about ``SLICE`` vectors, so that a large cell is the work of many tasks, and a slice meets its queries
in blocks of about ``BLOCK``.  A query first searches the region of its nearest cell; the k-th best score
found there is its floor, and the other regions return only what reaches it, at most k rows a slice.

Vectors that are null, empty or zero, or hold null or non-finite components take no part.  Vectors of
different lengths have no inner product: each length is an index of its own.  Each row is a vector of
its own; the query's own row is no candidate.  Ties go to the smaller id.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FIT_ROWS = 16_384
CENTROIDS = 1_024       # at most, of each half; the index has their square of cells
AUDITED = 64
REGIONS = 32
SLICE = 4_096
BLOCK = 4_096           # queries that meet a slice together
_AT_ONCE = 256          # queries scored together
_SLACK = 1e-9           # rounding of sums that are taken in another order
TARGET, MARGIN = 0.97, 1.25


def fit_half(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids of one half (Lloyd's algorithm on the fitting sample)."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = assign(x, c)
        count = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def assign(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (np.square(c).sum(1) - 2 * x @ c.T).argmin(1)


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, enough: float) -> Iterator[tuple[int, float]]:
    """Cells (left * len(right) + right) that hold vectors, with their summed distances, in the order of
    these, until ``enough`` entries are met."""
    a, b = np.argsort(left, kind="stable").tolist(), np.argsort(right, kind="stable").tolist()
    x, y = left[a].tolist(), right[b].tolist()
    width = len(b)
    heap, seen, met = [(x[0] + y[0], 0, 0)], {(0, 0)}, 0
    while heap and met < enough:
        total, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        if sizes[cell]:
            yield cell, total
            met += int(sizes[cell])
        for p, r in ((i + 1, j), (i, j + 1)):
            if p < len(a) and r < width and (p, r) not in seen:
                seen.add((p, r))
                heapq.heappush(heap, (x[p] + y[r], p, r))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def _best(score: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest scores, ties to the smaller key."""
    if len(score) > k:
        limit = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= limit)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((keys[some], -score[some]))[:k]]


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.einsum("nd,d->n", x, q)


def regions_of(sizes: np.ndarray, regions: int = REGIONS) -> np.ndarray:
    """The region of each left centroid: the largest ones first, each to the region that holds least."""
    out, load = np.zeros(len(sizes), np.int64), [(0, r) for r in range(min(regions, len(sizes)))]
    for c in np.argsort(-sizes, kind="stable").tolist():
        held, r = heapq.heappop(load)
        out[c] = r
        heapq.heappush(load, (held + int(sizes[c]), r))
    return out


def scored(q: np.ndarray, reach: np.ndarray, floor: np.ndarray, own: np.ndarray, x: np.ndarray, keys: np.ndarray, rows: np.ndarray,
           cell: np.ndarray, book: tuple[np.ndarray, np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places in x, exact scores) of the best k entries of a slice in each query's cells, from its floor on.

    Only the pairs of a query and a left centroid with a cell in reach are multiplied."""
    a, b = book
    h, width = a.shape[1], len(b)
    order = np.argsort(cell, kind="stable")
    x, keys, rows, cell = x[order], keys[order], rows[order], cell[order]
    left, right = cell // width, cell % width
    edges = np.r_[np.flatnonzero(np.r_[True, left[1:] != left[:-1]]), len(left)]
    for start in range(0, len(q), _AT_ONCE):
        some = q[start:start + _AT_ONCE]
        near_left, near_right = -(some[:, :h] @ a.T), -(some[:, h:] @ b.T)
        limit = reach[start:start + _AT_ONCE]
        limit = limit + _SLACK * (1 + np.abs(limit))
        s = np.full((len(some), len(x)), -np.inf)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            met = near_left[:, left[lo], None] + near_right[:, right[lo:hi]] <= limit[:, None]
            at = np.flatnonzero(met.any(1))
            if len(at):
                s[at, lo:hi] = np.where(met[at], some[at] @ x[lo:hi].T, -np.inf)
        for j in range(len(some)):
            s[j, rows == own[start + j]] = -np.inf
            least = floor[start + j]
            if s.shape[1] > k:
                least = max(least, np.partition(s[j], s.shape[1] - k)[s.shape[1] - k])
            at = np.flatnonzero((s[j] > -np.inf) & (s[j] >= least - _SLACK * (1 + abs(least)) if np.isfinite(least) else s[j] > -np.inf))
            if len(at):
                exact = exact_scores(x[at], some[j])
                best = _best(exact, keys[at], k)
                best = best[exact[best] >= floor[start + j]]
                yield start + j, order[at[best]], exact[best]


def search(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", embedding: str = "embedding", centroids: int = CENTROIDS,
           target: float = TARGET, slice_rows: int = SLICE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, key, score) for queries whose key is divisible by ``every``."""
    spark = vectors.sparkSession
    e = F.col("v")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("v")).where(F.col("key").isNotNull())
            .where(F.coalesce((F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0), F.lit(False)))
            .withColumn("row", F.monotonically_increasing_id()))
    rows = written(rows, "vectors")
    out = spark.createDataFrame([], f"query_id bigint, rank int, `{key}` bigint, score double")
    lengths = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if(F.col("key") % every == 0).alias("asked"))
               .where("asked > 0").orderBy("d").collect())   # one row for each length
    for r in lengths:
        found = _search(rows.where(F.size("v") == r.d), r.d, r.n, r.asked, every, k, centroids, target, slice_rows, block)
        out = out.unionByName(found.withColumnRenamed("key", key))
    return out


def _search(rows: DataFrame, d: int, n: int, asked_rows: int, every: int, k: int, centroids: int, target: float, slice_rows: int, block: int) -> DataFrame:
    """``search`` among n vectors of one length d, of which ``asked_rows`` are queries."""
    spark = rows.sparkSession
    # a sample of bounded expected size for the centroids
    share = max(1, -(-n // FIT_ROWS))
    fit = np.array([r.v for r in rows.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).orderBy(F.xxhash64("row")).limit(FIT_ROWS).select("v").collect()])
    if not len(fit):
        fit = np.array([r.v for r in rows.limit(1).select("v").collect()])
    h = (d + 1) // 2
    count = max(1, min(centroids, round(4 * n ** 0.25)))
    c1, c2 = fit_half(fit[:, :h], count), fit_half(fit[:, h:], count) if d > 1 else np.zeros((1, 0))
    book = spark.sparkContext.broadcast((c1, c2))
    cells = len(c1) * len(c2)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = book.value
        for batch in batches:
            x = _matrix(batch.column(1), d)
            cell = assign(x[:, :h], a) * len(b) + assign(x[:, h:], b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["key", "v", "row", "cell"])

    index = written(rows.mapInArrow(place, "key bigint, v array<double>, row bigint, cell int"), "index")
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").count().collect():   # at most one row for each cell
        sizes[r.cell] = r["count"]
    queries = index.where(F.col("key") % every == 0)

    # audit: exact neighbours of a few queries, from one pass over all vectors
    some = queries.orderBy(F.xxhash64("row")).limit(AUDITED).select("row", "v").collect()
    ask = spark.sparkContext.broadcast((np.array([r.row for r in some]), np.array([r.v for r in some])))

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = ask.value
        held: list = [None] * len(q)
        for batch in batches:
            x, keys, own = _matrix(batch.column(1), d), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            cell = batch.column(3).to_numpy()
            for j in range(len(q)):
                score = exact_scores(x, q[j])
                score[own == ids[j]] = -np.inf
                parts = (score, keys, cell)
                if held[j] is not None:
                    parts = tuple(np.r_[a, b] for a, b in zip(held[j], parts, strict=True))
                best = _best(parts[0], parts[1], k)
                held[j] = tuple(p[best] for p in parts)
        for j, parts in enumerate(held):
            if parts is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts[0]), j, np.int32)), *(pa.array(p) for p in parts)], ["q", "score", "key", "cell"])

    near = index.mapInArrow(truth, "q int, score double, key bigint, cell int")
    top = near.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "key", "cell"))), 1, k).alias("t"))
    needed = []
    for r in top.collect():   # k rows for each audited query
        v = some[r.q].v
        left, right = -(c1 @ np.array(v[:h])), -(c2 @ np.array(v[h:]))
        met, before = {}, 0
        for cell, _ in walk(left, right, sizes, np.inf):
            before += int(sizes[cell])
            met[cell] = before
        needed += [met[t.cell] for t in r.t if t.s < np.inf]
    # so many entries reach the target share of all audited neighbours
    enough = float(np.quantile(needed, target)) * MARGIN if needed else 1.0
    region_of = regions_of(sizes.reshape(len(c1), len(c2)).sum(1))
    region_sizes = np.bincount(region_of, sizes.reshape(len(c1), len(c2)).sum(1)).astype(np.int64)
    slices = np.maximum(1, -(-region_sizes // slice_rows))
    blocks = max(1, -(-asked_rows // block))
    shape = spark.sparkContext.broadcast((sizes, region_of))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, b), (size, region) = book.value, shape.value
        for batch in batches:
            x = _matrix(batch.column(1), d)
            left, right = -(x[:, :h] @ a.T), -(x[:, h:] @ b.T)
            own, reach, to, first = [], [], [], []
            for j in range(len(x)):
                found, total = zip(*walk(left[j], right[j], size, enough), strict=True)
                met = region[np.array(found) // len(b)]
                each = np.unique(met)
                own.append(np.full(len(each), j))
                reach.append(np.full(len(each), total[-1]))
                to.append(each)
                first.append(each == met[0])
            if own:
                at = pa.array(np.concatenate(own))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (0, 1, 2)), *(pa.array(np.concatenate(c)) for c in (reach, to, first))],
                                                 ["key", "v", "row", "reach", "region", "first"])

    asked = written(queries.select("key", "v", "row").mapInArrow(probe, "key bigint, v array<double>, row bigint, reach double, region bigint, first boolean"), "asked")
    asked = (asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(F.lit(slices.tolist()), F.col("region").cast("int") + 1).cast("int") - 1)))
             .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")))
    region = F.element_at(F.lit(region_of.tolist()), F.floor(F.col("cell") / len(c2)).cast("int") + 1)
    held = index.withColumn("region", region.cast("bigint"))
    held = (held.withColumn("part", F.pmod(F.xxhash64("row"), F.element_at(F.lit(slices.tolist()), F.col("region").cast("int") + 1)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("region", "part", "block", "key", "v", "row", "cell"))

    def score(qs: pa.Table, xs: pa.Table) -> pa.Table:
        made = [[np.zeros(0, t)] for t in (np.int64, np.int64, np.int64, float)]
        if qs.num_rows and xs.num_rows:
            x, keys, rows_, cell = _matrix(xs.column("v").combine_chunks(), d), *(xs.column(c).to_numpy() for c in ("key", "row", "cell"))
            q, ids, own, reach, floor = _matrix(qs.column("v").combine_chunks(), d), *(qs.column(c).to_numpy() for c in ("key", "row", "reach", "floor"))
            for j, at, exact in scored(q, reach, floor, own, x, keys, rows_, cell, book.value, k):
                for o, p in zip(made, (np.full(len(at), own[j]), np.full(len(at), ids[j]), keys[at], exact), strict=True):
                    o.append(p)
        return pa.table(dict(zip(("row", "query_id", "key", "score"), (np.concatenate(o) for o in made), strict=True)))

    def met(ask: DataFrame) -> DataFrame:
        by = ["region", "part", "block"]
        pairs = ask.select(*by, "key", "v", "row", "reach", "floor").groupBy(*by).cogroup(held.groupBy(*by))
        return best(pairs.applyInArrow(score, "row bigint, query_id bigint, key bigint, score double"))

    def best(found: DataFrame) -> DataFrame:
        """The best k of every query; each task keeps k of its rows before the shuffle."""
        w = Window.partitionBy("row", "query_id").orderBy(F.desc("score"), "key")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    near = written(met(asked.where("first").withColumn("floor", F.lit(float("-inf")))).drop("rank"), "near")
    floors = near.groupBy("row").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    rest = asked.where("not first").join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    return best(near.unionByName(met(rest).drop("rank"))).select("query_id", "rank", "key", "score")
