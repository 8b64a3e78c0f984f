"""The retry loop over written Parquet, and file halves that find no partner."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sensor_event as SEV
from tidewatch.plans import endpoint_queries, sensor_queries
from tidewatch.sources import dims as D
from tidewatch.streaming import pipelines as P
from tidewatch.streaming import retry as R

from .conftest import SF001


@pytest.fixture(scope="module")
def waiting(spark, tmp_path_factory):
    """Standard events that no asset table knew anything for, written once."""
    path = str(tmp_path_factory.mktemp("events") / "e")
    alerts = sensor_queries._alerts(spark, SF001).limit(40)
    details = endpoint_queries.asset_details(spark, SF001)
    SEV.standard_event(alerts, details.where("false"), D.attack_techniques(spark)).write.parquet(path)
    return spark.read.parquet(path), details


def ids(frame):
    return sorted(r.id for r in frame.select("id").collect())


def test_second_attempt_and_dead_after_the_last(spark, tmp_path, waiting):
    events, details = waiting
    loop = R.RetryLoop(spark, str(tmp_path / "q"), str(tmp_path / "ck"), max_attempts=2)
    loop.admit(events, 0)
    loop.admit(events, 0)  # a replay
    held = events.where(R.unresolved(events))
    assert ids(loop.read("waiting")) == ids(held)
    loop.run(details.where("false"))  # first attempt: nothing is known yet
    assert loop.read("recovered").count() == 0
    good = R.with_profiles(held, details).where("_ok")
    assert 0 < good.count() < held.count()
    loop.run(details)  # second attempt
    assert ids(loop.read("recovered")) == ids(good)
    assert ids(loop.read("dead")) == sorted(set(ids(held)) - set(ids(good)))
    loop.run(details)  # nothing is left
    assert loop.read("recovered").count() + loop.read("dead").count() == held.count()
    made = loop.read("recovered").select("event.threat_info.source_endpoint.asset_detail", "route", "attempt").collect()
    assert any(r.asset_detail.asset_id and r.asset_detail.ip_group for r in made)
    assert {r.route for r in made} == {"black"}
    assert {r.attempt for r in made} == {1}


def test_a_crashed_try_keeps_its_decision(spark, tmp_path, waiting):
    events, details = waiting
    loop = R.RetryLoop(spark, str(tmp_path / "q"), str(tmp_path / "ck"), max_attempts=3)
    held = events.where(R.unresolved(events))
    loop._try(held, 0, 0, details)
    before = ids(loop.read("recovered"))
    loop._try(held, 0, 0, details.where("false"))  # the same batch again, with other assets
    assert ids(loop.read("recovered")) == before
    assert sorted(ids(loop.read("waiting")) + before) == ids(held)


def test_halves_two_hours_apart_are_two_quarantine_rows(spark, tmp_path):
    x, c = tmp_path / "x", tmp_path / "c"
    x.mkdir()
    c.mkdir()
    at = "2024-01-01T{:02d}:00:00".format
    (x / "a.json").write_text("\n".join(json.dumps({"stem": s, "xml_time": at(t), "taskid": s}) for s, t in (("near", 1), ("far", 1), ("alone", 2))))
    (c / "a.json").write_text("\n".join(json.dumps({"stem": s, "pcap_time": at(t), "pcap_path": s}) for s, t in (("near", 2), ("far", 3), ("only", 2))))

    def run(k):
        xs = spark.readStream.schema("stem string, xml_time timestamp, taskid string").json(str(x))
        cs = spark.readStream.schema("stem string, pcap_time timestamp, pcap_path string").json(str(c))
        q = (P.pair_or_quarantine(xs, cs).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)

    run(0)
    for k in (10, 20):  # time goes on in both streams
        (x / f"{k}.json").write_text(json.dumps({"stem": f"x{k}", "xml_time": at(k), "taskid": "t"}))
        (c / f"{k}.json").write_text(json.dumps({"stem": f"c{k}", "pcap_time": at(k), "pcap_path": "p"}))
        run(k)
    got = {(r.stem, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).where(~F.col("stem").rlike("^[xc]2")).collect()}
    assert got >= {("near", None), ("far", "no_capture"), ("far", "no_metadata"), ("alone", "no_capture"), ("only", "no_metadata")}
    assert len([g for g in got if g[0] == "far"]) == 2
