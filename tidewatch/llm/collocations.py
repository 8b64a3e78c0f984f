"""Phrase collocations by dynamic itemset counting (DIC) over cyclic scans of shards.

The rows are dealt into S shards, and step t scans shard t mod S.  Single words are counted from step 0 on.
A longer phrase becomes active at the end of the step at which both its subphrases (without its last
word, and without its first) have reached the threshold; from the next step on its occurrences are
counted, beside the shorter phrases that are still being counted, until S steps have passed and each shard
was scanned once for it.  So lengths interleave, every count is exact, and a phrase that could not
reach the threshold is hardly ever counted.

What is active is known in the tasks by a table of one byte a slot: the step at which the first
phrase of the slot reached the threshold.  A slot's byte never changes once it is set, so phrases that
share a slot with an active one are merely counted too, over a whole cycle of their own: slots decide the
cost and never a count.  Tables have about one slot for 64 bytes of text and at most 2^27 (a broadcast
of at most 128 MB a length).

A task adds up its occurrences, and posts them as sorted, packed blocks, one for each bucket of keys, length and
cycle; buckets grow in number with the corpus.  One exchange a step brings a bucket's new blocks to
its running counts.  When a cycle ends, its counts below the threshold go.  Phrases are known by 64-bit keys: those of words are
hashes of language and bytes, those of longer phrases of their two subphrases' keys; spellings
are posted for active words only.

Null texts are empty; a null language is `und`.  Repeated rows count one by one.  Other columns are ignored.  Ties of
the score end by count and then by the phrase's bytes.  An empty table has no phrases.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import work_root, written
from .textbytes import LOWER, U64, hash_spans, mix, utf8_chunks

SHARDS = 3
LEAST = 10
LONGEST = 3
TOP = 2000
#: A part of a longer candidate goes if the longer one has at least this share (per cent) of its occurrences.
CONTAINED = 50
UNKNOWN = "und"

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True
_C = U64(0x9FB21C651E98DF25)
#: Occurrences that a task adds up before it posts them.
HELD = 8_000_000
_BLOCK = "bucket int, role string, level int, born int, old boolean, size bigint, keys binary, counts binary, a binary, b binary, lang string, words binary"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]
_TYPES = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 4, pa.string(), pa.binary()]


def _packed(values: np.ndarray) -> bytes:
    """Compressed planes of bytes."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes | None, size: int) -> np.ndarray:
    if not size or raw is None:
        return np.zeros(0, U64)
    planes = np.frombuffer(pa.decompress(raw, size * 8, codec="zstd"), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _deltas(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=U64(0)))


def _sums(raw: bytes | None, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(raw, size), dtype=U64)


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts, ends, hashes, row of each word, whether it follows the word before it in a piece)."""
    for row, data, offsets in utf8_chunks(texts):
        data = LOWER[data]
        n = len(data)
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = ~_APART[data]
        step = np.diff(inside)
        start_at, end_at = step == 1, step == -1
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        joined = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]  # a word runs over the end of a text
        start_at[joined] = True
        end_at[joined] = True
        starts, ends = np.flatnonzero(start_at), np.flatnonzero(end_at)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        breaks = np.zeros(n + 1, np.int32)
        np.cumsum(_BREAK[data], out=breaks[1:])
        follows = np.zeros(len(starts), bool)
        follows[1:] = (breaks[starts[1:]] == breaks[ends[:-1]]) & (owner[1:] == owner[:-1])
        yield row, data, starts, ends, hash_spans(data, starts, ends), owner, follows


class _Tally:
    """What a task has counted since it last posted."""

    def __init__(self, bits: int):
        self.bits = bits
        self.keys: dict[tuple[int, int], list] = {}
        self.held = 0
        self.names: dict[str, tuple[list, list]] = {}
        self.parts: dict[int, list] = {}
        self.known: dict[int, np.ndarray] = {}
        self.totals: dict[str, int] = {}

    def add(self, level: int, born: int, keys: np.ndarray, a=None, b=None) -> None:
        if len(keys):
            self.keys.setdefault((level, born), []).append((keys, a, b))
            self.held += len(keys)

    def fresh(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Places of keys that this task has not posted the meaning of."""
        keys, at = np.unique(keys, return_index=True)
        known = self.known.get(level, np.zeros(0, U64))
        where = np.searchsorted(known, keys)
        new = np.ones(len(keys), bool)
        inside = where < len(known)
        new[inside] = known[where[inside]] != keys[inside]
        self.known[level] = np.insert(known, where[new], keys[new])
        return at[new]

    def _slices(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        bounds = np.r_[np.searchsorted(keys, np.arange(1 << self.bits, dtype=U64) << U64(64 - self.bits)), len(keys)]
        for bucket in np.flatnonzero(np.diff(bounds)).tolist():
            yield bucket, slice(int(bounds[bucket]), int(bounds[bucket + 1]))

    def rows(self) -> Iterator[tuple]:
        for (level, born), held in self.keys.items():
            keys = np.concatenate([h[0] for h in held])
            if held[0][1] is None:
                keys.sort()
                at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                sums, a, b = np.diff(np.r_[at, len(keys)]), None, None
                keys = keys[at]
            else:
                keys, at, sums = np.unique(keys, return_index=True, return_counts=True)
                a, b = (np.concatenate([h[k] for h in held])[at] for k in (1, 2))
            for bucket, s in self._slices(keys):
                yield (bucket, "count", level, born, False, s.stop - s.start, _deltas(keys[s]), _packed(sums[s].astype(U64)),
                       a if a is None else _packed(a[s]), b if b is None else _packed(b[s]), None, None)
        for lang, (keys, words) in self.names.items():
            keys, words = np.concatenate(keys), np.array(words + [b""], object)[:-1]
            order = np.argsort(keys)
            keys, words = keys[order], words[order]
            for bucket, s in self._slices(keys):
                yield (bucket, "meaning", 1, 0, False, s.stop - s.start, _deltas(keys[s]), None, None, None, lang, b"\n".join(words[s]))
        for level, held in self.parts.items():
            keys, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys)
            keys, a, b = keys[order], a[order], b[order]
            for bucket, s in self._slices(keys):
                yield (bucket, "meaning", level, 0, False, s.stop - s.start, _deltas(keys[s]), None, _packed(a[s]), _packed(b[s]), None, None)
        for lang, n in self.totals.items():
            yield (0, "total", 0, 0, False, n, None, None, None, None, lang, None)
        self.keys, self.held, self.names, self.parts, self.totals = {}, 0, {}, {}, {}


def _batches(rows: Iterator[tuple], least: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r[6:] if x is not None)
        if size >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _TYPES, strict=True)], _NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _TYPES, strict=True)], _NAMES)


def _scan(shard: DataFrame, step: int, shards: int, longest: int, bits: int, slots: int, held: int, tables) -> DataFrame:
    """The blocks of one shard's occurrences of what is counted at this step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, tally = tables.value, _Tally(bits)
        lang_keys: dict[str, np.uint64] = {}
        for batch in batches:
            langs = [UNKNOWN if x is None else x for x in batch.column(0).to_pylist()]
            for x in set(langs) - set(lang_keys):
                raw = np.frombuffer(b"\xff" + x.encode(), np.uint8)
                lang_keys[x] = hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]
            of_row = np.array([lang_keys[x] for x in langs], U64)
            for row, data, starts, ends, h, owner, follows in _words(batch.column(1)):
                key = mix(h ^ of_row[row + owner])
                if step < shards:
                    tally.add(1, 0, key)
                    per_row = np.bincount(owner)
                    for r in np.flatnonzero(per_row).tolist():
                        lang = langs[row + r]
                        tally.totals[lang] = tally.totals.get(lang, 0) + int(per_row[r])
                near = follows[1:]
                for level in range(2, longest + 1):
                    at = reached[level - 2][key >> U64(64 - slots)]
                    told = np.flatnonzero((at > 0) & (at + shards > step))
                    if level > 2:
                        told = told[near_before[told]]  # noqa: F821
                    new = told[tally.fresh(level - 1, key[told])]
                    if len(new) and level == 2:
                        raw = data.tobytes()
                        for r, k in zip(owner[new].tolist(), new.tolist(), strict=True):
                            keys, words = tally.names.setdefault(langs[row + r], ([], []))
                            words.append(raw[starts[k]:ends[k]])
                            keys.append(key[k:k + 1])
                    elif len(new):
                        tally.parts.setdefault(level - 1, []).append((key[new], below[new], below[new + 1]))  # noqa: F821
                    born = np.maximum(at[:-1], at[1:])
                    use = near & (at[:-1] > 0) & (at[1:] > 0) & (born + shards > step)
                    with np.errstate(over="ignore"):
                        longer = mix(key[:-1] * _C + key[1:])
                    for g in np.unique(born[use]).tolist():
                        here = np.flatnonzero(use & (born == g))
                        tally.add(level, g, longer[here], *((key[here], key[here + 1]) if level == longest else ()))
                    below, key, near_before, near = key, longer, near, near[:-1] & near[1:]
                if tally.held > held:
                    yield from _batches(tally.rows())
        yield from _batches(tally.rows())

    return shard.select("lang", "text").mapInArrow(run, _BLOCK)


def _merge(blocks: DataFrame, step: int, shards: int, longest: int, least: int, bits: int, slots: int) -> DataFrame:
    """Adds up a bucket's blocks: counts that go on, those whose cycle is complete, the slots of phrases
    that have reached the threshold now, and meanings."""
    def bucket_rows(bucket: int, rows: list[dict]) -> Iterator[tuple]:
        counts: dict[tuple[int, int], list[dict]] = {}
        meanings: dict[tuple[int, str | None], list[dict]] = {}
        for r in rows:
            if r["role"] == "count":
                counts.setdefault((r["level"], r["born"]), []).append(r)
            elif r["role"] == "meaning":
                meanings.setdefault((r["level"], r["lang"]), []).append(r)
            else:
                yield tuple(r[c] for c in _NAMES)
        now: dict[int, list[np.ndarray]] = {}
        for (level, born), held in sorted(counts.items()):
            keys = np.concatenate([_sums(r["keys"], r["size"]) for r in held])
            times = np.concatenate([_unpacked(r["counts"], r["size"]) for r in held]).astype(np.int64)
            before = np.where(np.repeat([r["old"] for r in held], [r["size"] for r in held]), times, 0)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, times, before = keys[at], np.add.reduceat(times[order], at), np.add.reduceat(before[order], at)
            a = b = None
            if level == longest:
                a, b = (np.concatenate([_unpacked(r[c], r["size"]) for r in held])[order[at]] for c in "ab")
            else:
                now.setdefault(level, []).append(keys[(times >= least) & (before < least)])
            complete = step == born + shards - 1
            if complete:
                keep = times >= least
                keys, times = keys[keep], times[keep]
                a, b = (x if x is None else x[keep] for x in (a, b))
            if len(keys):
                yield (bucket, "done" if complete else "count", level, born, True, len(keys), _deltas(keys), _packed(times.astype(U64)),
                       a if a is None else _packed(a), b if b is None else _packed(b), None, None)
        for level, held in now.items():
            keys = np.concatenate(held)
            if len(keys):
                marks = np.zeros(1 << (slots - bits), bool)
                marks[((keys >> U64(64 - slots)) & U64((1 << (slots - bits)) - 1)).astype(np.int64)] = True
                raw = np.packbits(marks).tobytes()
                yield (bucket, "reached", level, 0, True, len(raw), pa.compress(raw, codec="zstd", asbytes=True), None, None, None, None, None)
        for (level, lang), held in meanings.items():
            keys, at = np.unique(np.concatenate([_sums(r["keys"], r["size"]) for r in held]), return_index=True)
            a = b = words = None
            if level == 1:
                words = b"\n".join(np.array([*(w for r in held for w in r["words"].split(b"\n")), b""], object)[at])
            else:
                a, b = (_packed(np.concatenate([_unpacked(r[c], r["size"]) for r in held])[at]) for c in "ab")
            yield (bucket, "meaning", level, 0, True, len(keys), _deltas(keys), None, a, b, lang, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            bucket, held = None, []
            for batch in batches:
                for r in batch.to_pylist():
                    if r["bucket"] != bucket and held:
                        yield from bucket_rows(bucket, held)
                        held = []
                    bucket = r["bucket"]
                    held.append(r)
            if held:
                yield from bucket_rows(bucket, held)

        yield from _batches(rows())

    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _BLOCK)


def _stored(blocks: DataFrame, step: int) -> DataFrame:
    """``blocks`` written with a folder for each role, so that a reader of one role opens no other."""
    spark = blocks.sparkSession
    path = f"{work_root(spark)}/{spark.sparkContext.applicationId}/phrases-{step}-{uuid.uuid4().hex}"
    blocks.write.partitionBy("role").parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def _opened(blocks: DataFrame) -> DataFrame:
    """(level, key, n, a, b, lang, word): the entries of done counts and meanings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["size"]
                keys = _sums(r["keys"], n).view(np.int64)
                longs = [pa.nulls(n, pa.int64()) if r[c] is None else pa.array(_unpacked(r[c], n).view(np.int64)) for c in ("counts", "a", "b")]
                words = pa.nulls(n, pa.string()) if r["words"] is None else pa.array([w.decode() for w in r["words"].split(b"\n")], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r["level"]] * n, pa.int32()), pa.array(keys), *longs, pa.array([r["lang"]] * n, pa.string()), words],
                                                 ["level", "key", "n", "a", "b", "lang", "word"])

    return blocks.mapInArrow(run, "level int, key bigint, n bigint, a bigint, b bigint, lang string, word string")


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", shards: int = SHARDS, least: int = LEAST, longest: int = LONGEST,
             slots: int | None = None, held: int = HELD) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of each length, and (lang, total).

    The table of a length has (key, a, b, lang, phrase, last, n, heads, tails): a and b are the keys of its subphrases,
    heads[k] and tails[k] the counts of its first and last k + 1 words.  ``slots`` sets the power of two of a table's slots.
    """
    spark = docs.sparkSession
    path = f"{work_root(spark)}/{spark.sparkContext.applicationId}/shards-{uuid.uuid4().hex}"
    (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).alias("bytes"),
                 (F.monotonically_increasing_id() % shards).cast("int").alias("shard"))
     .write.partitionBy("shard").option("compression", "zstd").parquet(path))
    dealt = spark.read.schema("lang string, text string, bytes int, shard int").parquet(path)
    size = dealt.agg(F.sum(F.col("bytes").cast("bigint"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(24, max(partitions, size >> 23).bit_length())
    slots = max(bits + 3, 16, min(27, (size >> 6).bit_length())) if slots is None else max(bits, slots)
    reached = [np.zeros(1 << slots, np.uint8) for _ in range(longest - 1)]
    latest = [0] * (longest - 1)
    state, stored, step = None, [], 0
    while step < shards or any(x and x + shards > step for x in latest):
        tables = spark.sparkContext.broadcast(reached)
        blocks = _scan(dealt.where(F.col("shard") == step % shards), step, shards, longest, bits, slots, held, tables)
        made = _stored(_merge(blocks if state is None else blocks.unionByName(state), step, shards, longest, least, bits, slots), step)
        state = made.where("role = 'count'")
        stored.append(made)
        for r in made.where("role = 'reached'").select("level", "bucket", "size", "keys").toLocalIterator():
            marks = np.unpackbits(np.frombuffer(pa.decompress(bytes(r["keys"]), r["size"], codec="zstd"), np.uint8), count=1 << (slots - bits)).astype(bool)
            own = reached[r["level"] - 1][r["bucket"] << (slots - bits):(r["bucket"] + 1) << (slots - bits)]
            own[marks & (own == 0)] = step + 1
            latest[r["level"] - 1] = step + 1
        tables.unpersist()
        step += 1
    every = stored[0]
    for made in stored[1:]:
        every = every.unionByName(made)
    totals = every.where("role = 'total'").groupBy("lang").agg(F.sum("size").alias("total"))
    done = written(_opened(every.where("role = 'done'")).drop("lang", "word"), "phrase_counts")
    meaning = _opened(every.where("role = 'meaning'"))
    meaning = written(meaning.groupBy("level", "key").agg(*(F.min(c).alias(c) for c in ("a", "b", "lang", "word"))), "phrase_meanings")
    none = F.lit(None).cast("bigint")
    level = [written(done.where("level = 1").select("key", "n").join(meaning.where("level = 1").select("key", "lang", "word"), "key").select(
        "key", none.alias("a"), none.alias("b"), "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", F.array("n").alias("heads"), F.array("n").alias("tails")), "phrases_1")]
    for k in range(2, longest + 1):
        own = done.where(F.col("level") == k)
        own = own.select("key", "n", "a", "b") if k == longest else own.select("key", "n").join(meaning.where(F.col("level") == k).select("key", "a", "b"), "key")
        first = level[-1].select(F.col("key").alias("a"), "lang", "phrase", "heads")
        rest = level[-1].select(F.col("key").alias("b"), "last", "tails")
        own = own.join(first, "a").join(rest, "b")
        level.append(written(own.select("key", "a", "b", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "n",
                                        F.concat("heads", F.array("n")).alias("heads"), F.concat("tails", F.array("n")).alias("tails")), f"phrases_{k}"))
    return level, totals


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", shards: int = SHARDS, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED,
         **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words.

    a, l and r count the phrase, its first part and the rest at the cut with the least score
    floor(1,000,000 a a / (l r)); n counts the language's words.  ``options`` go to ``frequent``."""
    level, totals = frequent(docs, lang, text, shards, least, longest, **options)
    big = lambda c: c.cast("decimal(14,0)")
    found = None
    for k in range(2, longest + 1):
        own = level[k - 1]
        for at in range(1, k):
            own = own.withColumn(f"l{at}", F.col("heads")[at - 1]).withColumn(f"r{at}", F.col("tails")[k - at - 1])
            own = (own.withColumn("x", F.lit(1_000_000).cast("decimal(7,0)") * (big(F.col("n")) * big(F.col("n")))).withColumn("y", big(F.col(f"l{at}")) * big(F.col(f"r{at}")))
                   .withColumn(f"cut{at}", F.struct(F.expr("x div y").alias("score"), F.lit(at).alias("k"), F.col(f"l{at}").alias("l"), F.col(f"r{at}").alias("r"))))
        own = own.withColumn("cut", F.least(*(F.col(f"cut{at}") for at in range(1, k))) if k > 2 else F.col("cut1"))
        own = own.select("key", "lang", "phrase", "n", "cut.score", "cut.l", "cut.r")
        if k < longest:
            longer = level[k].select(F.explode(F.array("a", "b")).alias("key"), F.col("n").alias("longer")).groupBy("key").agg(F.max("longer").alias("longer"))
            own = own.join(longer, "key", "left").where(F.coalesce(100 * F.col("longer") < contained * F.col("n"), F.lit(True))).drop("longer")
        found = own if found is None else found.unionByName(own)
    order = [F.desc("score"), F.desc("n"), F.asc("phrase")]
    # the best of each part of a language's phrases first, so that one task sees at most 64 x top of them
    part = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score")


ORACLE_SQL = rf"""
with pieces as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w
  from (select coalesce(lang, '{UNKNOWN}') as lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents where text is not null)),
places as (select lang, w, unnest(generate_series(1, len(w))) as i from pieces where len(w) > 0),
grams as (select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3 from places),
total as (select lang, count(*) as n from grams group by lang),
f1 as (select lang, w1, count(*) as f from grams group by all),
f2 as (select lang, w1, w2, count(*) as f from grams where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) as f from grams where w2 is not null and w3 is not null group by all having count(*) >= {LEAST}),
two as (
  select f2.lang, f2.w1 || ' ' || f2.w2 as phrase, f2.f as a, x.f as l, y.f as r,
         (1000000::hugeint * f2.f * f2.f) // (x.f::hugeint * y.f) as score
  from f2 join f1 x on x.lang = f2.lang and x.w1 = f2.w1 join f1 y on y.lang = f2.lang and y.w1 = f2.w2
  where f2.f >= {LEAST} and not exists (
    select 1 from f3 where f3.lang = f2.lang and ((f3.w1 = f2.w1 and f3.w2 = f2.w2) or (f3.w2 = f2.w1 and f3.w3 = f2.w2)) and 100 * f3.f >= {CONTAINED} * f2.f)),
cuts as (
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 as phrase, f3.f as a, 1 as k, x.f as l, y.f as r
  from f3 join f1 x on x.lang = f3.lang and x.w1 = f3.w1 join f2 y on y.lang = f3.lang and y.w1 = f3.w2 and y.w2 = f3.w3
  union all
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, x.f, y.f
  from f3 join f2 x on x.lang = f3.lang and x.w1 = f3.w1 and x.w2 = f3.w2 join f1 y on y.lang = f3.lang and y.w1 = f3.w3),
three as (
  select lang, phrase, a, l, r, score
  from (select *, row_number() over (partition by lang, phrase order by score, k) as place
        from (select *, (1000000::hugeint * a * a) // (l::hugeint * r) as score from cuts))
  where place = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from (select * from two union all select * from three))
select ranked.lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join total using (lang) where rank <= {TOP}
"""
