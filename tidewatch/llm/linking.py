"""From shared signatures to components of similar texts, without emitting all pairs of a group.

Input: postings (sig, id, size): text ``id`` has signature ``sig``; the upper half of ``size`` is the
number n of its different shingles, the lower half a bound: two similar texts share a signature at
which each one's bound is at least their overlap.

Sorted by signature, size class (sizes within a factor of 1 / similarity) and bound, the members of a
signature stream past a constant-size state that knows the first member of each class, the one with
the highest bound for its size, as the class's hub; another hub of a class is the member that shares
signatures with most others.  Round 1 verifies each text against the hub of either sort that it
meets most often: linear in the texts, and it joins nearly all of every large group.  Round 2
verifies those pairs of a signature whose bounds allow a link and whose ends are still in different
components.  Pairs inside a component can't change it, so leaving them out loses no component.

Texts travel packed, and only those that a pair has: ``texts_of`` is asked for the ends of the pairs of a round.

One of the bounds of round 2 is a bitmap of ``64 * LANES`` parities: shingles are dealt to bits, and a bit
says whether a set has an odd number of its shingles.  A bit in which two sets differ holds a shingle that
only one of them has, so there are at least as many of those as such bits.  More than a link allows
rules the pair out inside the join, without either text; no pair that is similar enough is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lean, written
from .textbytes import LOWER, U64, hash_spans, mix, utf8_chunks, words

SHINGLE = 5
SIMILAR = 80  # per cent
LANES = 8     # longs of a bitmap
_STEP = 1.25
_C = U64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets) for runs of rows: each text's different shingles, ascending.

    Words are runs without ASCII white space, with A-Z in lower case.  A text of fewer words than
    a shingle has its whole sequence as the only one; one without words has none.
    """
    for row, data, offsets in utf8_chunks(texts):
        data = LOWER[data]
        starts, ends, before = words(data, offsets)
        h = hash_spans(data, starts, ends)
        n_words = np.diff(before)
        count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
        first = np.cumsum(count) - count
        at = np.arange(int(count.sum())) + np.repeat(before[:-1] - first, count)
        short = np.repeat(np.where(n_words < size, n_words, size), count)
        with np.errstate(over="ignore"):
            total = short.astype(U64) * U64(0x165667B19E3779F9)
            power = U64(1)
            padded = np.r_[h, np.zeros(size, U64)]
            for j in range(size):
                total += np.where(j < short, padded[at + j], U64(0)) * power
                power = power * _C
        total = mix(total)
        limits = np.r_[0, np.cumsum(count)]
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            total[a:b].sort()
        fresh = np.ones(len(total), bool)
        fresh[1:] = total[1:] != total[:-1]
        edge = limits[:-1][count > 0]
        fresh[edge] = True
        kept = np.r_[0, np.cumsum(fresh)]
        yield row, total[fresh], kept[limits]


def set_id(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit number for each set (0 for an empty one)."""
    with np.errstate(over="ignore"):
        total = np.r_[U64(0), np.cumsum(mix(hashes + U64(0x27D4EB2F165667C5)))]
        size = np.diff(offsets)
        out = mix(total[offsets[1:]] - total[offsets[:-1]] + size.astype(U64) * _C)
    return np.where(size > 0, out, U64(0)).view(np.int64)


def posted(n: np.ndarray, bound: np.ndarray | None = None) -> np.ndarray:
    """The ``size`` column of postings."""
    return n.astype(np.int64) << 32 | (n if bound is None else bound).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of signatures that at least two texts have, with the hubs of their size class and
    of the class below.  Holds at most three rows from one batch to the next."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, kind, i, size, done = (np.r_[a, b] for a, b in zip(
            held, [*(batch.column(k).to_numpy().astype(np.int64) for k in range(4)), np.zeros(batch.num_rows, bool)], strict=True))
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (i[1:] != i[:-1])
        sig, kind, i, size, done = (x[fresh] for x in (sig, kind, i, size, done))
        new_run = np.r_[True, sig[1:] != sig[:-1]]
        new_group = new_run | np.r_[True, kind[1:] != kind[:-1]]
        run = np.cumsum(new_run) - 1
        group = np.cumsum(new_group) - 1
        hub_at = np.flatnonzero(new_group)
        below = np.full(len(hub_at), -1)
        if len(hub_at) > 1:
            a, b = hub_at[:-1], hub_at[1:]
            below[1:] = np.where((sig[a] == sig[b]) & (kind[a] + 1 == kind[b]), a, -1)
        hub, lower = hub_at[group], below[group]
        out = ~done & (np.bincount(run)[run] > 1)
        at = np.flatnonzero(out)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[at]), pa.array(i[at]), pa.array(size[at] >> 32), pa.array(size[at] & 0xFFFFFFFF),
                 pa.array(i[hub[at]], mask=hub[at] == at), pa.array(i[lower[at]], mask=lower[at] < 0)],
                ["sig", "id", "n", "bound", "hub", "lower"])
        last = len(sig) - 1
        keep = sorted({x for x in (lower[last], hub[last], last) if x >= 0})
        held = [x[keep] for x in (sig, kind, i, size)] + [(done | out)[keep]]


def members(postings: DataFrame) -> DataFrame:
    """(sig, id, n, bound, hub, lower) of signatures with several texts; one shuffle, streamed."""
    n = F.shiftright("size", 32)
    bound = F.col("size").bitwiseAND(0xFFFFFFFF)
    ordered = (postings.repartition("sig").withColumn("kind", F.floor(F.log(n) / float(np.log(_STEP)) + 1e-9).cast("int"))
               .sortWithinPartitions("sig", "kind", -F.floor(bound * 4096 / n), "id"))
    return ordered.select("sig", "kind", "id", "size").mapInArrow(lean(_runs), "sig bigint, id bigint, n bigint, bound bigint, hub bigint, lower bigint")


_PACK_FROM = 512   # bytes; shorter texts are left to the shuffle's own compression


def packed(texts: pa.Array) -> pa.Array:
    """Each text as its size before compression (0: it is as it was) and its bytes; null is empty."""
    out = []
    for x in texts.cast(pa.binary()).fill_null(b""):
        raw = x.as_py()
        if len(raw) < _PACK_FROM:
            out.append(b"\0\0\0\0" + raw)
        else:
            out.append(len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True))
    return pa.array(out, pa.binary())


def unpacked(texts: pa.Array) -> pa.Array:
    """The texts that ``packed`` made."""
    out = []
    for x in texts.to_pylist():
        n = int.from_bytes(x[:4], "little")
        out.append(pa.decompress(x[4:], n, codec="zstd", asbytes=True) if n else x[4:])
    return pa.array(out, pa.binary()).cast(pa.string())


def verified(pairs: DataFrame, texts: DataFrame, similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """Those (a, b) of ``pairs`` whose texts' shingle sets have 100 * intersection >= similar * union.

    ``texts`` has (id, text) with packed texts, each id once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            sets = []
            for c in (2, 3):
                sets.append([h[offsets[k]:offsets[k + 1]] for _, h, offsets in shingle_sets(unpacked(batch.column(c)), size) for k in range(len(offsets) - 1)])
            good = []
            for x, y in zip(*sets, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common > 0 and 100 * common >= similar * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    # the text of ``a`` travels with the pair; ``b`` is the hub, which many pairs share
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lean(run), "a bigint, b bigint")


def parities(h: np.ndarray, offsets: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """The bitmap of each set as a row of longs (zeros for an empty one)."""
    out = np.zeros((len(offsets) - 1, lanes), U64)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        lane, bit = (h >> U64(6)) % U64(lanes), U64(1) << (h & U64(63))
        for k in range(lanes):
            out[some, k] = np.bitwise_xor.reduceat(np.where(lane == U64(k), bit, U64(0)), offsets[some])
    return out.view(np.int64)


def bitmaps(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, bits0, bits1, ...) of (id, text), one row for each id."""
    names = [f"bits{k}" for k in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, h, offsets in shingle_sets(batch.column(1), size):
                bits = parities(h, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(bits)), *(pa.array(b) for b in bits.T.copy())], ["id", *names])

    made = texts.select("id", "text").mapInArrow(lean(run), "id bigint, " + ", ".join(f"{c} bigint" for c in names))
    return made.dropDuplicates(["id"])   # equal ids are equal sets


def link(postings: DataFrame, texts_of, similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """(node, component_id) of all texts that are similar to another one (by id).

    ``texts_of(ids)`` returns (id, text) for a table of ids: each id once, texts packed, from a written table.
    ``texts_of(ids, False)`` returns plain texts, and may repeat ids and have others.
    """
    multi = written(members(postings), "members").withColumn("kind", F.floor(F.log("n") / float(np.log(_STEP)) + 1e-9).cast("int"))
    met = (multi.select("id", "n", F.explode(F.array("hub", "lower")).alias("hub")).where("hub is not null and hub != id")
           .groupBy("id", "hub").agg(F.count("*").alias("c")))
    best = met.groupBy("id").agg(F.max_by("hub", F.struct("c", "hub")).alias("b")).select(F.col("id").alias("a"), "b")
    # a second hub: the member that meets most others, as the text that all of a group were made from does
    sizes = multi.groupBy("sig").agg(F.count("*").alias("c"))
    weight = multi.join(sizes, "sig").groupBy("id").agg(F.sum("c").alias("w"))
    top = multi.join(weight, "id").groupBy("sig", "kind").agg(F.max_by("id", F.struct("w", "id")).alias("top"))
    often = multi.select("sig", "kind", "id").join(top, ["sig", "kind"]).where("top != id").groupBy("id", "top").agg(F.count("*").alias("c"))
    second = often.groupBy("id").agg(F.max_by("top", F.struct("c", "top")).alias("b")).select(F.col("id").alias("a"), "b")
    best = written(best.unionByName(second).distinct(), "hubs")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    links = written(verified(best, texts_of(ends(best)), similar, size), "links")
    parts = written(components(links), "parts")
    x = multi.select("sig", "id", "n", "bound").join(parts.select(F.col("node").alias("id"), "component_id"), "id", "left")
    x = x.select("sig", "id", "n", "bound", F.coalesce("component_id", "id").alias("part"))
    open_ = x.groupBy("sig").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("sig")
    x = written(x.join(open_, "sig", "left_semi"), "open")
    # bitmaps are shuffled for the join below, texts aren't
    x = written(x.join(bitmaps(texts_of(x.select("id").distinct(), False), size), "id"), "bounded")
    # both sides have the same columns, so they are one shuffle
    one, two = x.alias("one"), x.alias("two")
    of = lambda c: (F.col(f"one.{c}"), F.col(f"two.{c}"))
    apart = reduce(add, (F.bit_count(p.bitwiseXOR(q)) for p, q in (of(f"bits{k}") for k in range(LANES))))
    n, m = of("n")
    left = (one.join(two, F.col("one.sig") == F.col("two.sig")).where((F.col("one.part") < F.col("two.part"))
                                                                      & (100 * F.least(n, m) >= similar * F.greatest(n, m))
                                                                      & ((100 + similar) * apart <= (100 - similar) * (n + m))
                                                                      & ((100 + similar) * F.least(*of("bound")) >= similar * (n + m)))
            .select(F.col("one.id").alias("a"), F.col("two.id").alias("b")).distinct())
    tried = best.select(F.col("a"), "b").unionByName(best.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = written(left.join(tried, ["a", "b"], "left_anti"), "pairs")
    more = written(verified(left, texts_of(ends(left)), similar, size), "links")
    if more.isEmpty():
        return parts
    return components(links.unionByName(more))
