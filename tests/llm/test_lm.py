"""Cross-entropy difference against dictionaries of counts."""

import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from tidewatch.llm import lm, queries

from ..conftest import SF001
from .conftest import with_clashes

BITS = 1 << 24     # so large that a few hundred words don't share buckets


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def model(texts):
    one, two = Counter(), Counter()
    for t in texts:
        w = tokens(t)
        if w:
            one[None] += 1
        one.update(w)
        two.update(zip([None, *w], w, strict=False))
    n = sum(two.values())

    def loss(prev, w):
        single = (one[w] + 0.5) / (n + 0.5 * BITS)
        return -math.log(min(1, (two[prev, w] + lm.PRIOR * single) / (max(one[prev], two[prev, w]) + lm.PRIOR)))
    return loss


def test_equals_dictionaries(spark):
    rows = [(i, r.text[:400]) for i, r in enumerate(spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect())]
    rows += [(50, None), (51, ""), (52, " \n"), (53, "One"), (53, "One"), (None, "two words")]
    good = rows[::3]
    target, background = model([t for _, t in good]), model([t for _, t in rows])
    want = []
    for k, t in rows:
        w = tokens(t)
        a, b = (sum(m(p, x) for p, x in zip([None, *w], w, strict=False)) / max(len(w), 1) for m in (target, background))
        want.append((k, len(w), a, b, b - a))
    out = lm.score(with_clashes(spark, rows), with_clashes(spark, good), n_words=BITS, n_pairs=BITS).collect()
    order = lambda x: (str(x[0]), x[1])
    for a, b in zip(sorted(want, key=order), sorted(map(tuple, out), key=order), strict=True):
        assert a[:2] == b[:2]
        assert b[2:] == pytest.approx(a[2:], rel=1e-9, abs=1e-9)


def test_prefers_the_target(spark):
    good = [(i, "the cat sat on the mat and looked at the bird") for i in range(30)]
    bad = [(100 + i, "buy now cheap pills click here to win money") for i in range(30)]
    out = {r.doc_id: r.score for r in lm.score(with_clashes(spark, good + bad), with_clashes(spark, good)).collect()}
    assert min(out[k] for k, _ in good) > max(out[k] for k, _ in bad)


def test_empty_tables(spark):
    assert lm.score(with_clashes(spark, []), with_clashes(spark, [])).count() == 0
    out = lm.score(with_clashes(spark, [(1, "a b")]), with_clashes(spark, [])).collect()
    assert out[0].n_words == 2


def test_query(spark):
    out = queries.QUERIES["op8_lm_score"](spark, SF001)
    assert out.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert out.where("isnan(score) or score is null").count() == 0


def test_registered_parameters_equal_dictionaries(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    # more different words and pairs than a fixed table would tell apart
    rows += [(10**6 + i, " ".join(f"x{i}y{j}" for j in range(3000))) for i in range(100)]
    good = rows[::3]
    monkeypatch.setitem(globals(), "BITS", len({w for _, t in rows for w in tokens(t)}))
    target, background = model([t for _, t in good]), model([t for _, t in rows])
    out = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(good, "doc_id bigint, text string")).collect()}
    for k, t in rows:
        w = tokens(t)
        a, b = (sum(m(p, x) for p, x in zip([None, *w], w, strict=False)) / max(len(w), 1) for m in (target, background))
        assert (out[k].n_words, out[k].target_loss, out[k].background_loss) == pytest.approx((len(w), a, b), rel=1e-9, abs=1e-9)


def test_many_runs_equal_one(spark, monkeypatch):
    rows = [(i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect())]
    rows += [(90, None), (91, ""), (None, "two words"), (None, "two words"), (92, "one " * 5000)]
    good = [r for r in rows if r[0] is not None and r[0] % 3 == 0]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = lm.score(docs, spark.createDataFrame(good, "doc_id bigint, text string")).collect()
    monkeypatch.setattr(lm, "RUN_BYTES", 4000)
    members = spark.createDataFrame([(k,) for k, _ in good] * 2 + [(None,), (10**6,)], "doc_id int")
    order = lambda r: (str(r.doc_id), r.n_words)
    for args in ((spark.createDataFrame(good, "doc_id bigint, text string"), None), (None, members)):
        out = lm.score(docs, args[0], members=args[1])
        for a, b in zip(sorted(whole, key=order), sorted(out.collect(), key=order), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-12)


def test_texts_are_shuffled_once_and_pairs_by_run(spark):
    # rows of each text's different pairs took more than four times the disk of the texts
    out = queries.QUERIES["op8_lm_score"](spark, SF001)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")]
    assert "ReusedExchange" in plan and "SortMergeJoin" not in plan
    block = lm._blocks(0, [pa.array(["a b c d " * 1000, "a b c d"])], None, 4)
    assert block.num_rows == 4 and sum(block.column("pairs").to_pylist()) == 5
