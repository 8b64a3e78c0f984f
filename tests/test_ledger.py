"""Id dictionaries: lazy numbering, and the ledger over batches and replays."""

import random

from pyspark.sql import functions as F

from tidewatch.operators.dictionary import Ledger, assign_new_ids
from tidewatch.sources import derive
from tidewatch.streaming import pipelines as P

from .conftest import SF001


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_numbers_follow_the_names(spark):
    rng = random.Random(2)
    seen = [rng.choice(["T10", "T1059.", "", "CVE-2021-", "é", "x"]) + str(rng.randrange(60)) for _ in range(500)] + [None, "", "=", "T"]
    known = [("T105", 7), ("x1", 3), ("unseen", 41)]
    out = assign_new_ids(names(spark, seen), spark.createDataFrame(known, "name string, id long"), "name", "id")
    new = sorted((set(seen) - {None} - {k for k, _ in known}), key=lambda s: s.encode())
    assert {r.name: r.id for r in out.collect()} == {n: 42 + k for k, n in enumerate(new)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    assert "Cartesian" not in out._jdf.queryExecution().toString()


def test_empty_sides(spark):
    nothing = spark.createDataFrame([], "name string, id long")
    assert assign_new_ids(names(spark, []), nothing, "name", "id").count() == 0
    assert [tuple(r) for r in assign_new_ids(names(spark, ["a"]), nothing, "name", "id").collect()] == [("a", 1)]


def test_ledger_batches_never_share_an_id(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ids"), start=spark.createDataFrame([("a", 5)], "name string, id long"))
    first = {r.name: r.id for r in ledger.claim(names(spark, ["b", "a", None, "c", "b"]), 0).collect()}
    second = {r.name: r.id for r in ledger.claim(names(spark, ["c", "d", "e"] * 300), 1).collect()}
    assert first == {"b": 6, "c": 7}
    assert second == {"d": 8, "e": 9}
    assert {r.name: r.id for r in ledger.read().collect()} == {"a": 5, "b": 6, "c": 7, "d": 8, "e": 9}
    assert {r.name for r in ledger.read(until=0).collect()} == {"a", "b", "c"}


def test_ledger_replay_issues_nothing(spark, tmp_path):
    Ledger(spark, str(tmp_path / "ids")).claim(names(spark, ["b", "c"]), 3)
    again = Ledger(spark, str(tmp_path / "ids"))  # another driver
    assert {r.name: r.id for r in again.claim(names(spark, ["z", "b"]), 3).collect()} == {"b": 1, "c": 2}
    assert again.batches() == [3]


def test_a_batch_that_died_claims_anew(spark, tmp_path):
    path = tmp_path / "ids" / "claims" / "batch=0"
    names(spark, ["half"]).withColumn("id", F.lit(1).cast("long")).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    ledger = Ledger(spark, str(tmp_path / "ids"))
    assert ledger.read().count() == 0
    assert [tuple(r) for r in ledger.claim(names(spark, ["whole"]), 0).collect()] == [("whole", 1)]
    assert ledger.batches() == [0]


def test_many_new_names_are_numbered_without_gaps(spark, tmp_path):
    got = Ledger(spark, str(tmp_path / "ids")).claim(spark.range(5000).select(F.concat(F.lit("CVE-2021-"), "id").alias("name")), 0)
    rows = sorted((r.name, r.id) for r in got.collect())
    assert [i for _, i in rows] == list(range(1, 5001))


def test_endpoint_micro_batches_share_the_ledger(spark, tmp_path):
    """Two micro-batches and a replay of the whole stream: every technique has one id."""
    from tidewatch.plans import endpoint_queries as Q

    topic = derive.endpoint_topic(derive.table(spark, SF001, "events")).where("offset < 60")
    src = str(tmp_path / "topic")
    topic.select("topic", "partition", "offset", "timestamp", "value").repartition(2).write.json(src)
    ledger = Ledger(spark, str(tmp_path / "ids"))
    flow = P.endpoint_flow(ledger, Q.asset_details(spark, SF001))
    runs = []
    for k in range(2):  # the second run replays the same batch ids from a new checkpoint
        q = P.standardise_stream(P.file_topic_stream(spark, src, max_files_per_trigger=1), flow, str(tmp_path / f"out{k}"), str(tmp_path / f"ck{k}"),
                                 numbered=True).trigger(availableNow=True).start()
        q.awaitTermination(600)
        attack = F.explode("event.threat_info.sponsor_behavior.attack_label.attack").alias("a")
        rows = spark.read.parquet(str(tmp_path / f"out{k}")).select("rowkey", attack).select("rowkey", "a.techniques", "a.techniques_number").collect()
        runs.append(sorted(map(tuple, rows)))
    claimed = {r.name: str(r.id) for r in ledger.read().collect()}
    assert len(set(claimed.values())) == len(claimed) > 10
    assert runs[0] == runs[1]
    assert all(n == claimed[t] for _, t, n in runs[0])
    assert len(ledger.batches()) == 2
