"""Language-model scores: the difference of two cross entropies (target minus background).

Two bigram models of the same form share one vocabulary: words are runs without white space, with A-Z
in lower case, and each text begins behind a start mark.  The background model counts every text of the
corpus, the target model every text of the target set.  With c the counts, N the words and V the
vocabulary,

    p(w)     = (c(w) + 0.5) / (N + 0.5 V)
    p(w | v) = min(1, (c(v, w) + M p(w)) / (max(c(v), c(v, w)) + M))

A document's score is the mean over its words of log p_target - log p_background: the higher, the more
it is like the target.  Every different word and pair is counted, known by a 64-bit hash, and V is the
number of different words.

The rows are dealt by their keys to runs of about ``RUN_BYTES`` of text.  A run counts its different
words and pairs and sends them, sorted, to buckets of hashes; a bucket adds up what all runs sent and
answers each run with the sums in the order of what it sent, so that no hash travels back.  The run's
texts meet the answers and are scored.  Both times the runs' texts come from one shuffle.  A frequent
word or pair is one entry of each run, whatever its count.

Null or empty texts and texts without words have 0 words and a score of 0.  Repeated rows count and
are scored one by one.  With an empty target set the target model is the smoothing alone.  Columns
other than the key and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import LOWER, U64, hash_spans, mix, utf8_chunks, words

PRIOR = 4.0       # M
RUN_BYTES = 16 << 20
_START = U64(0x51ED270B8C1F7A3D)
_BLOCK = ("bucket int, run int, pairs bigint, pair_block binary, words bigint, word_block binary, "
          "n_b bigint, n_t bigint, start_b bigint, start_t bigint")
_ANSWER = "run int, bucket int, pairs bigint, pair_block binary, words bigint, word_block binary, v bigint, n_b bigint, n_t bigint, start_b bigint, start_t bigint"
_NO_RUN = -1      # its blocks get no answer


def _grams(texts: Iterable[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, pairs with the word before, number of words of each row)."""
    out = [(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64))]
    for chunk in texts:
        for _, data, offsets in utf8_chunks(chunk):
            data = LOWER[data]
            starts, ends, before = words(data, offsets)
            h = hash_spans(data, starts, ends)
            n = np.diff(before)
            prev = np.r_[_START, h[:-1]] if len(h) else h
            prev[before[:-1][n > 0]] = _START
            with np.errstate(over="ignore"):
                out.append((h, mix(prev * U64(0x9FB21C651E98DF25) + h), n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers below 2**64 by their bytes of equal weight, compressed."""
    planes = np.stack([c.astype(U64) for c in columns]).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if planes.size else b""


def _unpack(block: bytes, n: int, columns: int) -> np.ndarray:
    if not n:
        return np.zeros((columns, 0), U64)
    planes = np.frombuffer(pa.decompress(block, 8 * n * columns, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, n).transpose(0, 2, 1)).view(U64).reshape(columns, n)


def _counted(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different values in order, how often each, how often among ``good``)."""
    order = np.argsort(x)
    x = x[order]
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]][:len(x)])
    before = np.r_[0, np.cumsum(good[order])]
    ends = np.r_[at[1:], len(x)][:len(at)]
    return x[at], ends - at, before[ends] - before[at]


def _blocks(run: int, texts: Iterable[pa.Array], good: np.ndarray | None, buckets: int) -> pa.RecordBatch:
    """A run's counts, a row for each bucket.  ``good`` marks its rows of the target; without it all
    rows are of the target and none of the corpus."""
    h, pair, n = _grams(texts)
    marks = np.ones(len(n), bool) if good is None else good
    inside = np.repeat(marks, n)
    edges = np.array([(i << 64) // buckets for i in range(buckets)], U64)
    columns = []
    for x in (pair, h):
        keys, b, t = _counted(x, inside)
        if good is None:
            b = np.zeros_like(b)
        cuts = np.r_[np.searchsorted(keys, edges), len(keys)]
        spans = [slice(i, j) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        columns += [pa.array(np.diff(cuts)), pa.array([_pack(np.diff(keys[s], prepend=U64(0)), b[s], t[s]) for s in spans], pa.binary())]
    whole = int(good is not None)
    sums = (whole * len(h), inside.sum(), whole * (n > 0).sum(), ((n > 0) & marks).sum())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(buckets, dtype=np.int32)), pa.array(np.full(buckets, run, np.int32)), *columns,
         *(pa.array(np.full(buckets, s, np.int64)) for s in sums)],
        ["bucket", "run", "pairs", "pair_block", "words", "word_block", "n_b", "n_t", "start_b", "start_t"])


def _answers(table: pa.Table) -> pa.Table:
    """The sums of a bucket for each run that sent to it, in the order of what it sent."""
    runs = table.column("run").to_numpy()
    asked = runs != _NO_RUN
    columns = {}
    for name, count in (("pair_block", "pairs"), ("word_block", "words")):
        sizes = table.column(count).to_numpy()
        parts = [_unpack(x.as_py(), n, 3) for x, n in zip(table.column(name), sizes, strict=True)]
        keys, of = np.unique(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]), return_inverse=True)
        b, t = (np.zeros(len(keys), U64) for _ in range(2))
        at = np.r_[0, np.cumsum(sizes)]
        for i, p in enumerate(parts):   # a block's keys differ
            mine = of[at[i]:at[i + 1]]
            b[mine] += p[1]
            t[mine] += p[2]
        own = [of[at[i]:at[i + 1]] for i in np.flatnonzero(asked)]
        columns |= {count: pa.array(sizes[asked]), name: pa.array([_pack(b[mine], t[mine]) for mine in own], pa.binary())}
    rows = int(asked.sum())
    columns["v"] = pa.array(np.full(rows, len(keys), np.int64))
    for c in ("n_b", "n_t", "start_b", "start_t"):
        columns[c] = pa.array(np.full(rows, table.column(c).to_numpy().sum(), np.int64))
    kept = table.filter(pa.array(asked))
    return pa.table({"run": kept.column("run"), "bucket": kept.column("bucket"), **columns})


def _losses(table: pa.Table, answers: pa.Table, n_words: int | None, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words, loss by the target, loss by the background) of each row of a run."""
    h, pair, n = _grams(table.column("text").chunks)
    answers = answers.sort_by("bucket")
    v = n_words if n_words is not None else sum(answers.column("v").to_pylist())
    first = {c: answers.column(c)[0].as_py() for c in ("n_b", "n_t", "start_b", "start_t")}
    (_, of_word), (_, of_pair) = (np.unique(x, return_inverse=True) for x in (h, pair))
    sums = {}
    for name, count in (("pair_block", "pairs"), ("word_block", "words")):
        sums[count] = np.concatenate([_unpack(x.as_py(), k, 2) for x, k in zip(answers.column(name), answers.column(count).to_pylist(), strict=True)], axis=1).astype(float)
    row = np.repeat(np.arange(len(n)), n)
    begins = np.r_[True, row[1:] != row[:-1]][:len(row)]
    out = []
    for i, c in ((1, "t"), (0, "b")):
        word, both = sums["words"][i][of_word], sums["pairs"][i][of_pair]
        prev = np.where(begins, first[f"start_{c}"], np.r_[0.0, word[:-1]][:len(word)])
        with np.errstate(divide="ignore", invalid="ignore"):
            p = (word + 0.5) / (first[f"n_{c}"] + 0.5 * v)
            loss = -np.log(np.minimum(1.0, (both + prior * p) / (np.maximum(prev, both) + prior)))
        out.append(np.bincount(row, loss, minlength=len(n)) / np.maximum(n, 1))
    return n, *out


def score(docs: DataFrame, target: DataFrame | None, key: str = "doc_id", text: str = "text", n_words: int | None = None, n_pairs: int | None = None,
          prior: float = PRIOR, members: DataFrame | None = None) -> DataFrame:
    """(key, n_words, target_loss, background_loss, score) of each row of ``docs``.  ``target`` holds texts
    of the target set in a column of the same name; instead of it, ``members`` may hold the keys of the rows
    of ``docs`` that make up the target set.  Losses are means over words in nats.  ``n_words``
    sets V; ``n_pairs`` has no effect, because every different pair is counted."""
    kind = docs.schema[key].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    runs = max(1, -(-size // RUN_BYTES))

    def run_of(k: str, otherwise: F.Column) -> F.Column:
        return F.pmod(F.when(F.col(k).isNull(), otherwise).otherwise(F.xxhash64(k)), F.lit(runs)).cast("int").alias("run")

    def post(docs: pa.Table, members: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.Table.from_batches([_blocks(0, [], np.zeros(0, bool), runs)]).slice(0, 0)
        good = pc.is_in(docs.column("id"), members.column("id"), skip_nulls=True)
        return pa.Table.from_batches([_blocks(docs.column("run")[0].as_py(), docs.column("text").chunks, good.to_numpy(), runs)])

    def post_target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0))
            size += batch.nbytes
            if size > RUN_BYTES:
                yield _blocks(_NO_RUN, held, None, runs)
                held, size = [], 0
        if held:
            yield _blocks(_NO_RUN, held, None, runs)

    def read(docs: pa.Table, answers: pa.Table) -> pa.Table:
        n, t, b = _losses(docs, answers, n_words, prior)
        return pa.table({key: docs.column("id"), "n_words": pa.array(n), "target_loss": pa.array(t), "background_loss": pa.array(b)})

    source = docs.select(run_of(key, F.xxhash64(text)), F.col(key).alias("id"), F.col(text).alias("text"))
    of = (docs.select(key).limit(0) if members is None else members.select(F.col(key).cast(kind))).where(F.col(key).isNotNull())
    of = of.select(run_of(key, F.lit(0)), F.col(key).alias("id"))
    blocks = source.groupBy("run").cogroup(of.groupBy("run")).applyInArrow(post, _BLOCK)
    if target is not None:
        blocks = blocks.unionByName(target.select(text).mapInArrow(post_target, _BLOCK))
    answers = blocks.groupBy("bucket").applyInArrow(_answers, _ANSWER)
    out = (source.groupBy("run").cogroup(answers.groupBy("run"))
           .applyInArrow(read, f"`{key}` {kind}, n_words bigint, target_loss double, background_loss double"))
    return out.withColumn("score", F.col("background_loss") - F.col("target_loss"))


def labelled(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """The keys of rows whose label is 1."""
    return labels.where(F.col(label) == 1).select(key)
