"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the whole text.  Its covariance is
shrunk towards a multiple of the identity (in units of the pooled standard deviations), and its
Cholesky factor is computed once; a document's score is the logistic function of the difference of
the two Mahalanobis log densities plus the log odds of the classes.

Statistics are computed where the text lies; only 64-bit sums of one row per class and entry of the
covariance reach the driver.  All labelled rows are used, no sample.

Null and empty texts have the statistics of no text and get a score like any other.  A label row
without quality counts for nothing, and so does a document whose label rows disagree.  With fewer
than two labelled rows in either class, every score is 0.5.  Repeated rows are scored one by one.
Columns of documents other than the key and the text are never read; ``keep`` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textbytes import U64, hash_spans, mix, utf8_chunks, words

SHRINKAGE = 0.1

_CLASS = np.zeros((8, 256), bool)
_CLASS[0, 65:91] = True                                    # capitals
_CLASS[1, 97:123] = True                                   # small letters
_CLASS[2, 48:58] = True                                    # digits
_CLASS[3, [ord(c) for c in ".,;:?'\"-()"]] = True          # usual punctuation
_CLASS[4, 33:127] = ~(_CLASS[:4].any(0))[33:127]           # other marks
_CLASS[5, [32, 9, 11, 12, 13]] = True                      # spaces
_CLASS[6, 10] = True                                       # line ends
_CLASS[7, 128:] = True                                     # bytes of other scripts and accents
NAMES = ("length", "words", "word_length", "word_length_spread", "capitals", "digits", "punctuation", "marks", "spaces", "line_length",
         "accents", "distinct_words", "distinct_lines", "longest_word", "marked_words", "sentence_length")


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each owner has."""
    with np.errstate(over="ignore"):
        _, first = np.unique(mix(hashes + owner.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner[first], minlength=n)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    out = np.zeros((len(texts), len(NAMES)))
    for row, data, offsets in utf8_chunks(texts):
        n, size = len(offsets) - 1, np.diff(offsets)
        count = np.zeros((8, n))
        for k in range(8):
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(_CLASS[k][data], out=total[1:])
            count[k] = np.diff(total[offsets])
        starts, ends, before = words(data, offsets)
        n_words = np.diff(before)
        owner = np.repeat(np.arange(n), n_words)
        length = (ends - starts).astype(float)
        mean = np.bincount(owner, length, n) / np.maximum(n_words, 1)
        square = np.bincount(owner, length * length, n) / np.maximum(n_words, 1)
        longest = np.zeros(n)
        np.maximum.at(longest, owner, length)
        last = data[ends - 1] if len(ends) else data[:0]
        marked = np.bincount(owner, _CLASS[4][last], n) if len(last) else np.zeros(n)
        stops = np.bincount(owner, last == ord("."), n) if len(last) else np.zeros(n)
        distinct = _distinct(hash_spans(data, starts, ends), owner, n)
        at = np.flatnonzero(data == 10)
        line_starts = np.union1d(offsets[:-1][size > 0], at[~np.isin(at + 1, offsets)] + 1)
        line_starts = line_starts[line_starts < len(data)]
        line_ends = np.r_[line_starts[1:], len(data)] if len(line_starts) else line_starts
        line_owner = np.searchsorted(offsets, line_starts, "right") - 1
        lines = np.bincount(line_owner, minlength=n)
        line_ends = line_ends - (data[line_ends - 1] == 10) if len(line_ends) else line_ends
        distinct_lines = _distinct(hash_spans(data, line_starts, line_ends), line_owner, n)
        s, w, ln = np.maximum(size, 1), np.maximum(n_words, 1), np.maximum(lines, 1)
        rate = lambda x, of: np.log(x / of + 0.002)
        out[row:row + n] = np.stack([
            np.log1p(size), np.log1p(n_words), np.log1p(mean), np.log1p(np.sqrt(np.maximum(square - mean * mean, 0))),
            rate(count[0], s), rate(count[2], s), rate(count[3], s), rate(count[4], s), rate(count[5], s), np.log1p(size / ln),
            rate(count[7], s), np.log(np.where(n_words > 0, distinct / w, 1) + 0.01), np.log(np.where(lines > 0, distinct_lines / ln, 1) + 0.01),
            np.log1p(longest), rate(marked, w), np.log1p(n_words / (stops + 1))], axis=1)
    return out


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log normalisers of class 0 and 1; None: not enough labels."""

    scale: np.ndarray | None = None
    mean: np.ndarray | None = None
    factor: np.ndarray | None = None
    constant: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.scale is None:
            return np.full(len(x), 0.5)
        log = [self.constant[c] - 0.5 * np.square((x / self.scale - self.mean[c]) @ self.factor[c].T).sum(1) for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -500, 500)))


def held_out(key: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the transformed statistics of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], [key, "x"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, x array<double>")


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", shrinkage: float = SHRINKAGE) -> Model:
    """Class moments as distributed sums, then the factors."""
    p = len(NAMES)
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("low"), F.max(label).alias("high"))
             .where("low = high").select(key, F.col("low").cast("int").alias("label")))
    rows = stats.where(~held_out(key)).join(known, key).select("label", "x")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + p + p * p))
        for batch in batches:
            y = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(-1, p)
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
        width = total.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], width), pa.int32()), pa.array(np.tile(np.arange(width), 2), pa.int32()), pa.array(total.ravel())],
            ["label", "entry", "value"])

    entries = rows.mapInArrow(sums, "label int, entry int, value double").groupBy("label", "entry").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((2, 1 + p + p * p))
    for r in entries:
        total[r.label, r.entry] = r.value
    n = total[:, 0]
    if n.min() < 2:
        return Model()
    mean = total[:, 1:1 + p] / n[:, None]
    second = total[:, 1 + p:].reshape(2, p, p)
    pooled = second.sum(0) / n.sum() - np.outer(total[:, 1:1 + p].sum(0), total[:, 1:1 + p].sum(0)) / n.sum() ** 2
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    mean /= scale
    factor, constant = [], []
    for c in (0, 1):
        cov = second[c] / n[c] / np.outer(scale, scale) - np.outer(mean[c], mean[c])
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / p, 1e-3) * np.eye(p)
        lower = np.linalg.cholesky(cov)
        factor.append(np.linalg.inv(lower))
        constant.append(np.log(n[c] / n.sum()) - np.log(np.diag(lower)).sum())
    return Model(scale, mean, np.array(factor), np.array(constant))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of each row; statistics are written once and read twice."""
    stats = written(measured(docs, key, text), "statistics")
    model = fit(stats, labels, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], [key, "score"])

    return (stats.mapInArrow(run, f"`{key}` {stats.schema[key].dataType.simpleString()}, score double")
            .select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all columns as they are.

    One pass measures all texts, so that the fit joins labels with a few numbers instead of
    texts; a second one scores and filters.  No text is shuffled.
    """
    model = fit(written(measured(docs, key, text), "statistics"), labels, key)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics(batch.column(at))) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
