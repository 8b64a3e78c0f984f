"""Substring dedup by paragraphs: MinHash banding finds candidates, exact Jaccard verifies them, and
components decide which occurrences go.

A paragraph is a line of at least ``MIN_WORDS`` words.  Its set of five-word shingles is its identity
(equal sets are one node), and each band of its MinHash signature is posted as a signature.  Bands
are tuned: the fewest rows in all whose recall at the threshold is at least ``RECALL``.  ``linking``
verifies colliding paragraphs exactly (similarity 80 % or more) and finds the components; within
large groups it verifies against hubs, so no group's pairs are all emitted.

Of each component the occurrence with the smallest (key, line number) stays; all others go.

Of what then is left, each run of ``WINDOW`` words that occurs in several rows is found exactly,
wherever its lines begin and end: it stays in the row with the smallest (key, row_hash), and all its
words go from the others.  The smallest hash of a window's ``GRAM``-word runs is its anchor; equal
windows have equal anchors, so rows first post their different anchors (about one for 16 words), and
then only those windows whose anchor another row has too.  Both steps are grouped minima: no pairs.

Null and empty texts have no paragraphs.  Rows with equal key and equal text are copies of one document
and share its decisions.  A null key sorts first.  Columns of the input other than the text and its
length keep their values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, sifted, written
from .linking import SHINGLE, SIMILAR, link, packed, posted, set_id, shingle_sets
from .textbytes import LOWER, U64, hash_spans, mix, utf8_chunks, words

MIN_WORDS = 40
RECALL = 0.999
WINDOW, GRAM = 50, 20
_C = 0x9FB21C651E98DF25
_C_INV = pow(_C, -1, 2**64)


@lru_cache
def tuned_bands(similar: float, recall: float = RECALL, most_rows: int = 8, false_at: float = 0.4, false_rate: float = 0.3) -> tuple[int, int]:
    """(bands, rows of each): the fewest hashes with the wanted recall at ``similar`` that lets
    pairs of similarity ``false_at`` collide with a probability of at most ``false_rate``."""
    best = None
    for rows in range(2, most_rows + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similar ** rows)))
        if 1 - (1 - false_at ** rows) ** bands <= false_rate and (best is None or bands * rows < best[0] * best[1]):
            best = bands, rows
    return best or (bands, rows)


def _lines(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number in it, start and end of each line of at least ``least`` words."""
    at = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], at + 1)
    starts = starts[starts <= len(data)]
    owner = np.searchsorted(offsets, starts, "right") - 1
    inside = owner < len(offsets) - 1
    starts, owner = starts[inside], owner[inside]
    ends = np.minimum(np.r_[starts[1:], len(data)], offsets[owner + 1])
    ends = ends - ((ends > starts) & (data[np.maximum(ends, 1) - 1] == 10) if len(data) else 0)
    # a line that ends a text with a line end is followed by an empty one, which has no words anyway
    first = np.searchsorted(owner, owner)
    word_at = words(data, offsets)[0]
    count = np.searchsorted(word_at, ends) - np.searchsorted(word_at, starts)
    good = np.flatnonzero(count >= least)
    return owner[good], (np.arange(len(starts)) - first)[good], starts[good], ends[good]


def _paragraphs(texts: pa.Array, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """(first row, text, line number, the paragraphs' texts) for runs of rows."""
    for row, data, offsets in utf8_chunks(texts):
        owner, number, starts, ends = _lines(data, offsets, least)
        raw = data.tobytes()
        yield row, owner, number, pa.array([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()).cast(pa.string())


def _sets(paragraphs: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of all paragraphs of a run, end to end."""
    hashes, offsets = [], [np.zeros(1, np.int64)]
    for _, h, o in shingle_sets(paragraphs, size):
        hashes.append(h)
        offsets.append(o[1:] + offsets[-1][-1])
    return (np.concatenate(hashes) if hashes else np.zeros(0, U64)), np.concatenate(offsets)


def minhash_bands(h: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signature for each set and band; sets must not be empty."""
    rng = np.random.default_rng(97)
    out = np.zeros((len(offsets) - 1, bands), U64)
    for band in range(bands):
        total = np.full(len(offsets) - 1, band + 1, U64)
        for _ in range(rows):
            a, b = (U64(x) for x in rng.integers(1, 2**63, 2, dtype=np.uint64))
            with np.errstate(over="ignore"):
                value = h * (a * U64(2) + U64(1)) + b
                value ^= value >> U64(32)
                total = mix(total * U64(0x9FB21C651E98DF25) + np.minimum.reduceat(value, offsets[:-1]))
        out[:, band] = total
    return out


def occurrences(docs: DataFrame, key: str, text: str, least: int, size: int) -> DataFrame:
    """(key, row_hash, line, id, chars): each paragraph of each row; row_hash tells texts apart.
    A row without paragraphs has one with a null line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, owner, number, paragraphs in _paragraphs(batch.column(2), least):
                h, offsets = _sets(paragraphs, size)
                at = pa.array(owner + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(number.astype(np.int32)), pa.array(set_id(h, offsets))], [key, "row_hash", "line", "id"])

    source = docs.select(key, F.xxhash64(text).alias("row_hash"), text)
    return source.mapInArrow(lean(run), f"`{key}` {docs.schema[key].dataType.simpleString()}, row_hash bigint, line int, id bigint")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS, similar: int = SIMILAR, size: int = SHINGLE) -> DataFrame:
    """(key, row_hash, line, first_key, removed) of each paragraph whose component has several occurrences."""
    bands, rows = tuned_bands(similar / 100)
    found = written(occurrences(docs, key, text, least, size), "paragraphs")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, paragraphs in _paragraphs(batch.column(0), least):
                if not len(paragraphs):
                    continue
                h, offsets = _sets(paragraphs, size)
                sig = minhash_bands(h, offsets, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.ravel().view(np.int64)), pa.array(np.repeat(set_id(h, offsets), bands)), pa.array(np.repeat(posted(np.diff(offsets)), bands))], ["sig", "id", "size"])

    def texts_of(ids: DataFrame, once: bool = True) -> DataFrame:
        place = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"))
        reps = written(found.join(ids, "id", "left_semi").groupBy("id").agg(F.min(place).alias("first")).select(F.col("first.key").alias("_key")).distinct(), "reps")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, _, paragraphs in _paragraphs(batch.column(0), least):
                    yield pa.RecordBatch.from_arrays([pa.array(set_id(*_sets(paragraphs, size))), paragraphs], ["id", "text"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), packed(batch.column(1))], ["id", "text"])

        # whole texts aren't shuffled: a sieve leaves the rows that may have a wanted paragraph, another one such paragraphs
        near = sifted(docs.select(key, text), F.xxhash64(key), reps, F.xxhash64("_key")).where("_near")
        texts = sifted(near.select(text).mapInArrow(lean(run), "id bigint, text string"), F.xxhash64("id"), ids, F.xxhash64("id")).where("_near").drop("_near")
        if not once:
            return texts
        return written(texts.join(ids, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(pack, "id bigint, text binary"), "texts")

    parts = link(docs.select(text).mapInArrow(lean(post), "sig bigint, id bigint, size bigint"), texts_of, similar, size)
    placed = (found.join(parts.select(F.col("node").alias("id"), F.col("component_id").alias("part")), "id", "left")
              .withColumn("part", F.coalesce("part", "id")))
    place = F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), "line", "row_hash")
    groups = placed.groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("part", "first")
    return placed.join(groups, "part").select(
        key, "row_hash", "line", F.col("first.key").alias("first_key"), (place != F.col("first")).alias("removed"))


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` neighbours."""
    with np.errstate(over="ignore"):
        power, inverse = (np.cumprod(np.r_[U64(1), np.full(len(h), c, U64)]) for c in (_C, _C_INV))
        total = np.r_[U64(0), np.cumsum(h * power[:-1])]
        return mix((total[n:] - total[:-n]) * inverse[:len(h) - n + 1])


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` neighbours."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def _windows(texts: pa.Array, gone: list, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, hash, anchor, first character, end) of each window of words outside the ``gone`` lines."""
    for row, data, offsets in utf8_chunks(texts):
        starts, ends, before = words(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        marks = [i << 32 | np.asarray(x, np.int64) for i, x in enumerate(gone[row:row + len(offsets) - 1]) if x]
        if marks:
            lines = np.r_[0, np.cumsum(data == 10)]
            kept = ~np.isin(owner << 32 | (lines[starts] - lines[offsets[owner]]), np.concatenate(marks))
            starts, ends, owner = starts[kept], ends[kept], owner[kept]
        if len(starts) < window:
            continue
        h = hash_spans(LOWER[data], starts, ends)
        at = np.flatnonzero(owner[:len(h) - window + 1] == owner[window - 1:])
        gram = min(GRAM, window)
        anchor = _lowest(_rolled(h, gram), window - gram + 1)[at]
        chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        base = chars[offsets[owner[at]]]
        yield owner[at] + row, _rolled(h, window)[at].view(np.int64), anchor.view(np.int64), chars[starts[at]] - base, chars[ends[at + window - 1]] - base


def _place(key: str) -> F.Column:
    return F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), "row_hash")


def _several(posts: DataFrame, key: str, by: str) -> DataFrame:
    """Values of ``by`` that several rows have, with the first of these rows.  Written, so that the
    join behind it has plain exchanges and a hot value's rows are split."""
    groups = posts.groupBy(by).agg(F.min(_place(key)).alias("first"), F.max(_place(key)).alias("last"))
    return written(groups.where("first != last").select(by, "first"), by)


def shared(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(_key, _hash, repeated_spans, removed_spans, spans_from) of each row that shares a window of words with
    another one.  ``gone`` holds (_key, _hash, _gone): lines that are gone already.  Spans are
    characters of the whole text, with their ends excluded."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(key, F.xxhash64(text).alias("row_hash"), text)
    lines = lambda rows: (rows.join(gone, F.col(key).eqNullSafe(F.col("_key")) & (F.col("row_hash") == F.col("_hash")), "left")
                          .select(key, "row_hash", text, "_gone"))
    row = F.xxhash64(key, "row_hash")
    apart = sifted(source, row, gone, F.xxhash64("_key", "_hash"))
    # only rows that may have lines gone are shuffled with their texts
    own = (lines(apart.where("_near").drop("_near"))
           .unionByName(apart.where("not _near").select(key, "row_hash", text, F.lit(None).cast("array<int>").alias("_gone"))))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, _, anchor, _, _ in _windows(batch.column(2), batch.column(3).to_pylist(), window):
                order = np.lexsort((anchor, owner))
                owner, anchor = owner[order], anchor[order]
                fresh = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])][:len(owner)])
                at = pa.array(owner[fresh])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor[fresh])], [key, "row_hash", "anchor"])

    def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(4)
            for owner, h, anchor, first, end in _windows(batch.column(2), batch.column(3).to_pylist(), window):
                limits = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True][:len(owner) + 1]) if len(owner) else np.zeros(1, int)
                good = np.zeros(len(owner), bool)
                for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
                    good[a:b] = np.isin(anchor[a:b], wanted[int(owner[a])].values.to_numpy())
                at = pa.array(owner[good])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(h[good]), pa.array(first[good] << 32 | end[good])], [key, "row_hash", "window", "span"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            columns = []
            for c in (2, 3):
                starts, ends, limits = [], [], [0]
                for x in batch.column(c):
                    x = np.sort(x.values.to_numpy())
                    a, b = x >> 32, x & 0xFFFFFFFF
                    new = np.flatnonzero(np.r_[True, a[1:] >= b[:-1]][:len(a)])
                    starts.append(a[new])
                    ends.append(b[np.r_[new[1:], len(b)] - 1] if len(b) else b)
                    limits.append(limits[-1] + len(new))
                pair = [pa.array(np.concatenate(x).astype(np.int32)) if x else pa.array([], pa.int32()) for x in (starts, ends)]
                columns.append(pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.StructArray.from_arrays(pair, fields=list(of))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, batch.column(4)], ["_key", "_hash", "repeated_spans", "removed_spans", "spans_from"])

    found = written(own.mapInArrow(lean(anchors), f"`{key}` {kind}, row_hash bigint, anchor bigint"), "anchors")
    wanted = (found.join(_several(found, key, "anchor").select("anchor"), "anchor").groupBy(F.col(key).alias("w_key"), F.col("row_hash").alias("w_hash"))
              .agg(F.collect_set("anchor").alias("wanted")))
    wanted = written(wanted, "wanted")
    own = lines(sifted(source, row, wanted, F.xxhash64("w_key", "w_hash")).where("_near").drop("_near"))
    some = own.join(wanted, F.col(key).eqNullSafe(F.col("w_key")) & (F.col("row_hash") == F.col("w_hash"))).select(key, "row_hash", text, "_gone", "wanted")
    found = written(some.mapInArrow(lean(posts), f"`{key}` {kind}, row_hash bigint, window bigint, span bigint"), "windows")
    both = found.join(_several(found, key, "window"), "window").withColumn("removed", _place(key) != F.col("first"))
    by = both.groupBy(F.col(key).alias("_key"), F.col("row_hash").alias("_hash")).agg(
        F.collect_set("span").alias("repeated"), F.collect_set(F.when(F.col("removed"), F.col("span"))).alias("removed"),
        F.collect_set(F.when(F.col("removed"), F.col("first.key"))).alias("spans_from"))
    spans = "array<struct<start:int,end:int>>"
    return by.mapInArrow(merged, f"_key {kind}, _hash bigint, repeated_spans {spans}, removed_spans {spans}, spans_from array<{kind}>")


def _found(docs: DataFrame, key: str, text: str, least: int, window: int) -> tuple[DataFrame, DataFrame]:
    """What goes and what repeats, by row: lines, then spans of the other lines."""
    by = written(repeats(docs, key, text, least).groupBy(F.col(key).alias("_key"), F.col("row_hash").alias("_hash")).agg(
        F.sort_array(F.collect_set("line")).alias("repeated_lines"),
        F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line")))).alias("_gone"),
        F.collect_set(F.when(F.col("removed"), F.col("first_key"))).alias("lines_from")), "lines")
    return by, written(shared(docs, by.where("size(_gone) > 0").select("_key", "_hash", "_gone"), key, text, window), "spans")


def _with(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    found = found.withColumnsRenamed({"_key": "f_key", "_hash": "f_hash"})
    return docs.join(found, F.col(key).eqNullSafe(F.col("f_key")) & (F.col("_own") == F.col("f_hash")), "left").drop("f_key", "f_hash")


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: key, n_repeated (paragraphs whose component occurs again),
    n_removed, repeated_from (the keys in which what goes occurs first), repeated_lines, removed_lines,
    and the same for runs of words in other lines: repeated_spans, removed_spans."""
    lines, spans = _found(docs, key, text, least, window)
    out = _with(_with(docs.select(key, F.xxhash64(text).alias("_own")), lines, key), spans, key)
    none = F.array()
    kind = f"array<{docs.schema[key].dataType.simpleString()}>"
    out = out.withColumnRenamed("_gone", "removed_lines")
    start_from = F.array_union(*(F.coalesce(f"{c}_from", none.cast(kind)) for c in ("lines", "spans")))
    return out.select(key, *(F.coalesce(F.size(f"{c}_lines"), F.lit(0)).cast("bigint").alias(f"n_{c}") for c in ("repeated", "removed")),
                      F.sort_array(start_from).alias("repeated_from"),
                      *(F.coalesce(f"{c}_lines", none.cast("array<int>")).alias(f"{c}_lines") for c in ("repeated", "removed")),
                      *(F.coalesce(f"{c}_spans", none.cast(spans.schema[f"{c}_spans"].dataType)).alias(f"{c}_spans") for c in ("repeated", "removed")))


def _without(text: str, lines: list, spans: list) -> str:
    """``text`` without whole lines and without the characters of ``spans``; a line of which no word is left goes."""
    drop, out, at = set(lines), [], 0
    for j, line in enumerate(text.split("\n")):
        end = at + len(line)
        if j not in drop:
            cuts = [(max(a, at) - at, min(b, end) - at) for a, b in spans if a < end and b > at]
            left = "".join(line[a:b] for a, b in zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(line)], strict=True))
            if not cuts or left.strip():
                out.append(left)
        at = end + 1
    return "\n".join(out)


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """``docs`` without the paragraphs and spans that go; every row stays, all columns but the text as they are."""
    at, order = docs.columns.index(text), docs.columns
    lines, spans = _found(docs, key, text, least, window)
    lines = lines.where("size(_gone) > 0").select("_key", "_hash", "_gone")
    spans = spans.where("size(removed_spans) > 0").select("_key", "_hash", F.col("removed_spans").alias("_spans"))
    # only rows that may lose something are shuffled with their texts
    apart = sifted(docs.withColumn("_own", F.xxhash64(text)), F.xxhash64(key, "_own"),
                   lines.select("_key", "_hash").unionByName(spans.select("_key", "_hash")), F.xxhash64("_key", "_hash"))
    both = _with(_with(apart.where("_near").drop("_near"), lines, key), spans, key).select(*order, "_gone", "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists, cuts = (batch.column(c).to_pylist() for c in (at, len(order), len(order) + 1))
            for i, (gone, cut) in enumerate(zip(lists, cuts, strict=True)):
                if gone or cut:
                    texts[i] = _without(texts[i], gone or [], [(x["start"], x["end"]) for x in cut or []])
            columns = list(batch.columns[:len(order)])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, order)

    return both.mapInArrow(lean(run), docs.schema).unionByName(apart.where("not _near").select(*order))
