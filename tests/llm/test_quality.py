"""Quality classifier: held-out accuracy, folds, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import quality, queries

from ..conftest import SF01
from .conftest import with_clashes


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1, n0 = label.sum(), (1 - label).sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_held_out(spark):
    sf = SF01
    out = {r.doc_id: r for r in queries.QUERIES["op1_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for k, r in out.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    held = [k for k in labels if out[k].held_out]
    y = np.array([labels[k] for k in held])
    assert auc(np.array([out[k].score for k in held]), y) > 0.95
    assert np.mean([out[k].predicted == labels[k] for k in held]) > 0.93


def test_score_ignores_labels_of_the_held_out_fold(spark):
    rows = [(i, ("good words in a row. " * 5 if i % 2 else "!!## $$ ## ") + str(i)) for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(60)]
    flipped = [(i, (1 - q) if zlib.crc32(str(i).encode()) % 3 == 1 else q, 0) for i, q, _ in labels]
    schema = "doc_id bigint, quality int, toxic int"
    a, b = (sorted((r.doc_id, r.score) for r in quality.classify(with_clashes(spark, rows), spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped))
    assert [k for k, _ in a] == [k for k, _ in b]
    np.testing.assert_allclose([s for _, s in a], [s for _, s in b], rtol=1e-9)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (1, 0, 0), (2, None, 0)]])
def test_too_few_labels(spark, labels):
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "x"), (4, "word " * 20000)]
    out = quality.classify(with_clashes(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(out) == len(rows)
    assert {(r.score, r.predicted) for r in out} == {(0.5, 1)}
    assert quality.keep(with_clashes(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).count() == len(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.classify(with_clashes(spark, []), none).count() == 0


def test_statistics_do_not_depend_on_the_batch():
    texts = ["One line.\nTwo lines.\n", "", None, "A A A a a", "é ü!! ## 12", "no end of line", "x\n\n\ny"]
    whole = quality.statistics(pa.array(texts, pa.string()))
    single = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    np.testing.assert_allclose(whole, single)
    assert np.isfinite(whole).all()


def test_keep_is_what_classify_predicts(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    want = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == want
