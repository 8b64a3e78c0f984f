"""The pipeline: stages in order, each stage's decisions against its operator, whole run."""

import inspect

import corpus_pipeline as P
from tidewatch.llm import packing, queries
from tidewatch.llm.common import components, read, work_root

from ..conftest import SF001
from .test_setjoin import brute as join_brute


def test_stages_in_order(spark):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "substring dedup", "PII", "packing"]
    docs = read(spark, SF001, "documents")
    rows = {}
    for name, stage in P.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = stage(spark, docs, SF001)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        rows[name] = out.count()
        if name == "n-gram Jaccard join":
            texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
            want = {k for k, n, c in join_brute(texts) if k == c}
            assert {r.doc_id for r in out.collect()} == want
        docs = out.cache()
    assert rows["substring dedup"] == rows["n-gram Jaccard join"] == rows["PII"]


def test_run_and_registration(spark):
    out = queries.QUERIES["pipeline"](spark, SF001)
    assert set(out.columns) == {"doc_id", *(c.split()[0] for c in packing.SCHEMA.split(", "))}
    assert out.count() > 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5000, 5000), (None, 3), (2000, 2001), (2002, 2001)]
    out = {r.node: r.component_id for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {out[i] for i in range(301)} == {0}
    assert (out[1000], out[1001], out[2000], out[2002]) == (1000, 1000, 2000, 2000)
    assert 5000 not in out
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_work_folder(spark):
    assert work_root(spark)
