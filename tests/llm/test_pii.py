"""Personal data against Python's regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import pii, queries

from ..conftest import SF001, SF01
from .conftest import with_clashes

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, text):
    d = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in text.split(".")),
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(kind, m[0]))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in spans]


def odd_texts():
    rng = random.Random(3)
    parts = [*"aB0123456789 ..--@@++()_%é日😀\n", "4111111111111111", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "a@b.co", "1.2.3.4",
             "+1 415 555 2671", "256.1.1.1", "0001.2.3.4"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 80))) for _ in range(600)]
    return texts + [None, "", "1" * 20000, "a" * 20000, "a@" * 4000, "1 " * 6000, "x@y.z " * 1500, "+1 (" * 4000, "1.2.3.4 " * 1500, "a.b@" + "c." * 4000]


def matches(rows, texts):
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(texts)
    for k, t in texts.items():
        want, r = brute(t), got[k]
        assert [s for s in r.spans.split(",") if s and not s.startswith("iban")] == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k2 + ":") for s in want) for k2 in BASE)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query(spark, sf):
    matches(queries.QUERIES["op4_pii"](spark, sf).collect(),
            {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})


def test_odd_texts(spark, table_dir):
    rows = list(enumerate(odd_texts()))
    path = table_dir(documents=(rows, "doc_id bigint, text string"))
    matches(queries.QUERIES["op4_pii"](spark, path).collect(), dict(rows))


def test_added_kind_and_scores(spark):
    rows = [(1, "IBAN GB82 WEST 1234 5698 7654 32, please"), (2, "GB82 WEST 1234 5698 7654 33"), (3, "x DE89370400440532013000"), (4, "call 1.2.3.4 or +1 415 555 2671")]
    out = {r.doc_id: r.spans for r in pii.find(with_clashes(spark, rows)).collect()}
    assert [(s.kind, s.value) for s in out[1]] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert out[2] == []
    assert [(s.kind, s.start, s.end) for s in out[3]] == [("iban", 2, 24)]
    assert out[1][0].score > out[3][0].score
    assert {s.kind: s.score for s in out[4]}["phone"] == pii.PRIOR["phone"] + 0.2 or {s.kind: s.score for s in out[4]}["phone"] == pii.PRIOR["phone"]


def test_masked(spark):
    rows = [(1, "call me a@b.co now 4111111111111111, +1 415 555 2671."), (2, None), (3, "plain é"), (4, "+4111111111111111 x"), (4, "+4111111111111111 x")]
    out = [(r.doc_id, r.text, r.spans) for r in pii.masked(with_clashes(spark, rows)).orderBy("doc_id").collect()]
    assert out == [(1, "call me <email> now <card>, <phone>.", "sp"), (2, None, "sp"), (3, "plain é", "sp"), (4, "+<card> x", "sp"), (4, "+<card> x", "sp")]


def test_empty_table_and_plan(spark):
    d = pii.find(with_clashes(spark, []))
    assert d.count() == 0
    plan = d.select(F.size("spans"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
