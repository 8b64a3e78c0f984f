"""Plans: builders run no jobs, and a hot address is split by the lookup join."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.operators import assets as A

from .conftest import SF001


def own_queries():
    from tidewatch.plans import registry

    registry.load_all()
    return sorted(registry.QUERIES)


@pytest.mark.parametrize("name", own_queries())
def test_building_runs_no_shuffle(spark, name):
    """Only Parquet footers are read while a query is built."""
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        E.queries()[name](spark, SF001)
        tracker = spark.sparkContext.statusTracker()
        for job in tracker.getJobIdsForGroup(f"build-{name}"):
            info = tracker.getJobInfo(job)
            assert len(info.stageIds) == 1     # a footer read has one stage, no shuffle
            assert tracker.getStageInfo(info.stageIds[0]) is None or tracker.getStageInfo(info.stageIds[0]).numTasks <= 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def small_skew(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark, tmp_path):
    """A third of 30,000 messages come from one address."""
    r = spark.range(0, 30_000, 1, 6)
    ip = F.when(F.col("id") % 3 == 0, "10.0.0.7").otherwise(F.concat(F.lit("10.1."), (F.col("id") % 200).cast("string"), F.lit(".9")))
    r.select("id", ip.alias("ip"), F.md5(F.col("id").cast("string")).alias("payload")).write.parquet(str(tmp_path / "hot"))
    ips = spark.createDataFrame([("A", "10.0.0.7"), ("B", "10.0.0.7"), ("C", "10.1.3.9")], "asset_id string, ip_addr string")
    return spark.read.parquet(str(tmp_path / "hot")), ips


def test_hot_address_is_split(spark, tmp_path, small_skew):
    records, ips = _hot(spark, tmp_path)
    out = A.enrich_sides(records, A.ip_to_asset(ips), {"src": "ip"}, ["asset_id"])
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == 30_000


def test_software_messages_are_made_and_parsed_once(spark):
    # the last message of each asset took a second pass over the messages
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = E.queries()["inv_software_state"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("from_json(") == 1 and "ReusedExchange" in plan


def test_a_last_message_without_packages_ends_all_installs(spark):
    from tidewatch.operators import inventory as INV
    known = spark.createDataFrame([("a", "x", "1", "2020"), ("b", "x", "1", "2020"), ("c", "x", "1", "2020")], "asset_id string, software_name string, version string, install_time string")
    kind = "array<struct<path:string,ver:string,name:string,instime:string,author:string>>"
    rows = [("a", True, 1, [("p", "2", "x", "t", "v")]), ("a", True, 2, None), ("b", True, 1, [("p", None, "x", "t", "v"), ("p", "3", "g??", "t", "v")]), ("c", False, 1, [])]
    reports = spark.createDataFrame(rows, f"asset_id string, asset_known boolean, offset bigint, softwareinfo {kind}").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    out = sorted(map(tuple, INV.software_state(known, reports).collect()))
    assert out == [("a", "x", "2", "0"), ("b", "x", "1", "1"), ("c", "x", "1", "1")]


def test_sieve_parts_rows_and_loses_none(spark):
    from tidewatch.functions.plan import sieved
    rows = spark.createDataFrame([(k,) for k in [*range(400), 7, 7, None, None]], "k bigint")
    side = spark.createDataFrame([(k,) for k in [*range(0, 400, 40), 900, 7, None]], "k bigint")
    near, far = (sorted((r.k for r in sieved(rows, F.xxhash64("k"), side, F.xxhash64("k"), inside).collect()), key=str) for inside in (True, False))
    assert sorted([*near, *far], key=str) == sorted((r.k for r in rows.collect()), key=str)
    assert {*range(0, 400, 40), 7, None} <= {*near} and near.count(7) == 3 and len(near) < 30
    assert sieved(rows, F.xxhash64("k"), side.limit(0), F.xxhash64("k"), False).count() == rows.count()


def test_whole_messages_are_shuffled_for_the_asset_only(spark):
    # for their offset and their technique they were too; the assets of all addresses were made
    from tidewatch.operators import endpoint as EP
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = E.queries()["endpoint_standard_events"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    lines = [line.strip(" :+-") for line in plan.split("\n")]
    assert sum("hashpartitioning(source_ip" in x for x in lines) == 1 and not any("hashpartitioning(technique" in x for x in lines)
    assert any(x.startswith("ShuffledHashJoin [source_ip") for x in lines) and "LeftAnti" in plan and plan.count("from_json(") <= 6
    assert any(x.endswith("collect_set(software_name)") or "collect_set(software_name" in x for x in lines)
    # repeated, undecodable and null offsets
    good = '{"type": "eventlog", "client": {"uuid": "u%d", "server_ip": "192.0.2.0"}}'
    rows = [("t", 0, 1, good % 1), ("t", 0, 1, good % 1), ("t", 0, 2, good % 2), ("t", 1, 2, "{no"), ("t", 1, 2, "{no"), ("t", 1, 2, good % 3), ("t", 1, 3, "{no"),
            ("t", None, None, good % 4), ("t", None, None, good % 4), ("t", None, 1, good % 5)]
    topic = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    for whole in (False, True):
        events, bad = EP.decode(topic, whole=whole)
        assert sorted(r.uuid for r in events.select("client.uuid").collect()) == ["u1", "u2", "u3", "u4", "u5"]
        assert sorted((r.partition, r.offset) for r in bad.collect()) == [(1, 2), (1, 3)]


def test_asset_details_of_named_addresses(spark):
    from tidewatch.plans.endpoint_queries import asset_details
    every = {r.ip_addr: r for r in asset_details(spark, SF001).collect()}
    some = sorted(every)[::7] + ["10.9.9.9", None]
    got = {r.ip_addr: r for r in asset_details(spark, SF001, spark.createDataFrame([(x,) for x in some], "ip_addr string")).collect()}
    assert {*some[:-2]} <= {*got} and len(got) < len(every) / 2
    assert all(every[k] == r for k, r in got.items())
