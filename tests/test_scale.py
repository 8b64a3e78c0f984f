"""What keeps a query's driver, tasks and shuffles from growing with the tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.operators import sensor as S
from tidewatch.operators import sensor_event as SEV
from tidewatch.sources import derive
from tidewatch.sources import dims as D

from .conftest import SF001


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_addresses_are_never_broadcast(spark):
    """The driver would hold every address of the inventory."""
    plan = plan_of(E.queries()["inv_hardware"](spark, SF001))
    assert "BroadcastExchange" not in plan
    assert plan.count("SortMergeJoin") == 2


@pytest.mark.parametrize("topic", [derive.firewall_topic, derive.sensor_topic, derive.endpoint_topic])
def test_topics_of_events_are_spread(spark, topic):
    """One small file, yet as many tasks as the session has shuffle partitions make and parse its messages."""
    made = topic(derive.table(spark, SF001, "events")).select(F.spark_partition_id().alias("p"), "value")
    rows = made.where(F.length("value") > 0).groupBy("p").count().collect()
    assert len(rows) == 8
    assert max(r["count"] for r in rows) < 2 * sum(r["count"] for r in rows) / 8


def test_alerts_without_lookups_do_not_meet(spark):
    """Five of six alerts have no attack label and half of them no destination to look up."""
    alerts = S.standardise(derive.sensor_topic(derive.table(spark, SF001, "events")))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        details = spark.createDataFrame([("10.0.0.1", "A", "os", "u", "d")], "ip_addr string, asset_id string, os_ver string, unit string, detail string")
        for out in (SEV.with_attack_labels(alerts, D.attack_techniques(spark)), SEV.with_assets(alerts.where("dst.ip NOT LIKE '1%'"), details)):
            rows = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert max(rows) < sum(rows) / 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_registry_reads_each_topic_once(spark):
    """One scan of the events for each of the three topics."""
    assert plan_of(E.queries()["device_registry"](spark, SF001)).count("FileScan parquet") == 3


def test_messages_do_not_pass_the_joins(spark):
    """No exchange of endpoint_events holds the parsed message: its unit is read before the joins."""
    df = E.queries()["endpoint_events"](spark, SF001)
    found, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            found += 1
            assert not {"data", "value"} & {a.name() for side in (node.left(), node.right()) for a in map(side.output().apply, range(side.output().size()))}
    assert found >= 2


def test_messages_are_shuffled_once(spark):
    """Only the events themselves drop re-delivered offsets, the set of technique names needs no such shuffle."""
    plan = plan_of(E.queries()["endpoint_events"](spark, SF001))
    assert sum("Exchange hashpartitioning" in line and "offset#" in line for line in plan.splitlines()) == 1
