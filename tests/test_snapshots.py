"""Versioned bucketed tables: replays, reopening, and a plan that leaves the snapshot in place."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import snapshots as ST

T0 = dt.datetime(2024, 1, 1)
CHANGES = "node_id string, node_name string, parent_node_id string, node_type_id string, timestamp timestamp, offset bigint"


@pytest.fixture
def warehouse(spark, tmp_path):
    """Tables of a test leave the catalog again."""
    yield str(tmp_path / "tables")
    for t in spark.catalog.listTables():
        if t.name.split("_")[0] in ("org", "device", "asset", "source", "endpoint"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def test_upserts_and_replay(spark, warehouse):
    t = ST.org_node_table(spark, warehouse, buckets=4)
    t.apply(0, changes(spark, [("a", "A", "1", "1", T0, 1), ("b", "B", "a", "2", T0, 2), ("a", "A2", "1", "1", T0, 3), (None, "x", "1", "1", T0, 4)]))
    assert rows_of(t) == [("a", "A2", "1", "1"), ("b", "B", "a", "2")]
    t.apply(1, changes(spark, [("b", "B2", "a", "2", T0, 5), ("c", "C", "a", "2", T0, 6)]))
    want = [("a", "A2", "1", "1"), ("b", "B2", "a", "2"), ("c", "C", "a", "2")]
    assert rows_of(t) == want
    assert t.version() == 2
    t.apply(1, changes(spark, [("b", "other", "a", "2", T0, 9), ("d", "D", "a", "2", T0, 9)]))  # a replay
    assert (rows_of(t), t.version(), t.applied()) == (want, 2, {0, 1})
    assert sorted(map(tuple, t.read(1).collect())) == [("a", "A2", "1", "1"), ("b", "B", "a", "2")]


def test_unkeyed_changes_are_told(spark, warehouse):
    t = ST.org_node_table(spark, warehouse)
    assert t.unkeyed(changes(spark, [(None, "x", "1", "1", T0, 4), ("a", "A", "1", "1", T0, 1)])).count() == 1


def test_another_session_reads_the_newest_version(spark, warehouse):
    ST.org_node_table(spark, warehouse, buckets=4).apply(0, changes(spark, [("a", "A", "1", "1", T0, 1)]))
    for t in spark.catalog.listTables():  # a new session's catalog knows none of them
        spark.sql(f"DROP TABLE IF EXISTS {t.name}") if t.name.startswith("org_node") else None
    t = ST.org_node_table(spark, warehouse, buckets=64)  # the table keeps the buckets that it has
    assert rows_of(t) == [("a", "A", "1", "1")]
    t.apply(1, changes(spark, [("a", "B", "1", "1", T0, 1)]))
    assert rows_of(t) == [("a", "B", "1", "1")]


def test_a_version_without_an_entry_does_not_exist(spark, warehouse):
    t = ST.org_node_table(spark, warehouse, buckets=4)
    t.apply(0, changes(spark, [("a", "A", "1", "1", T0, 1)]))
    import pathlib

    for mark in pathlib.Path(warehouse, "manifest").rglob("_SUCCESS"):
        mark.unlink()
    assert t.version() == 0
    t.apply(0, changes(spark, [("a", "B", "1", "1", T0, 1)]))
    assert rows_of(t) == [("a", "B", "1", "1")]


def test_only_the_changes_are_shuffled(spark, warehouse):
    """No exchange above the snapshot's scan: the one exchange deals out the changes by key."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = ST.device_table(spark, warehouse, buckets=6)
        first = spark.range(4000).select(F.col("id").cast("string").alias("device_id"), F.lit("t").alias("device_type_id"), F.lit(T0).alias("last_seen"))
        t.apply(0, first)
        more = spark.range(3990, 4010).select(F.col("id").cast("string").alias("device_id"), F.lit("t").alias("device_type_id"), F.lit(T0 + dt.timedelta(1)).alias("last_seen"))
        out = t.merged(more)
        assert out.count() == 4010
        assert out.where("_op <> 'keep' AND last_seen = timestamp'2024-01-02'").count() == 20
        plan = out._jdf.queryExecution().executedPlan().toString()
        initial = plan.split("Initial Plan")[-1]
        lines = initial.splitlines()
        scan = next(k for k, line in enumerate(lines) if "FileScan parquet" in line and "device_" in line)
        depth = lines[scan].index("FileScan")
        above = []
        for line in reversed(lines[:scan]):  # the path from the scan up to the join
            at = len(line) - len(line.lstrip(" :+-"))
            if at < depth:
                above.append(line)
                depth = at
        assert any("Join" in line for line in above)
        assert not any("Exchange" in line for line in above)
        assert "Bucketed: true" in lines[scan]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_many_batches_equal_the_last_change_of_each_key(spark, warehouse):
    rng = random.Random(4)
    t = ST.org_node_table(spark, warehouse, buckets=3)
    want = {}
    for batch in range(4):
        rows = [(f"n{rng.randrange(40)}", f"name{rng.randrange(9)}", "1", "2", T0 + dt.timedelta(days=batch), k) for k in range(60)]
        t.apply(batch, changes(spark, rows).repartition(4))
        for r in rows:
            want[r[0]] = r[:4]
    assert rows_of(t) == sorted(want.values())


def test_known_assets_keep_what_a_report_does_not_set(spark, warehouse):
    t = ST.asset_table(spark, warehouse, buckets=2)
    columns = [x.split()[0] for x in ST.ASSET.split(", ")]
    row = lambda key, name, person, node: tuple({"asset_id": key, "asset_name": name, "use_person": person, "node_id": node}.get(c, "d") for c in columns)
    t.apply(0, spark.createDataFrame([row("a", "A", "p", "5")], ST.ASSET))
    t.apply(1, spark.createDataFrame([row("a", "A2", "q", "9"), row("b", "B", "p", "9")], ST.ASSET))
    got = {r.asset_id: (r.asset_name, r.use_person, r.node_id, r.source) for r in t.read().collect()}
    assert got == {"a": ("A2", "q", "5", "d"), "b": ("B", "p", "9", "d")}


def test_discovered_assets_are_maintained(spark, warehouse):
    """What a batch discovers goes into both tables; the next batch with the same addresses finds them there."""
    from tidewatch.operators import assets as A

    seen = spark.createDataFrame([("10.9.0.1", "00-11-22-33-44-55", "2", "dev1", "own"), ("10.9.0.1", None, "4", "fw", None), ("10.9.0.2", None, "4", "fw", None), ("bad", None, "4", "fw", None), ("10.9.0.3", "m1", "4", "fw", None)],
                                 "ip_addr string, mac_addr string, source string, reporter string, own_id string")
    networks = spark.createDataFrame([], "node_id string, networktype string, data_type string, ip string, end_ip string, mask string")
    assert sorted((r.ip_addr, r.reason) for r in A.malformed(seen).collect()) == [("10.9.0.3", "mac"), ("bad", "address")]
    assets, ips = ST.asset_table(spark, warehouse + "/a", buckets=2), ST.asset_ip_table(spark, warehouse + "/i", buckets=2)
    for batch in range(2):
        rows, addresses = A.discovered_tables(A.discovered(seen, ips.read(), assets.read(), networks))
        assert rows.count() == (2, 0)[batch]
        ips_before = addresses.collect()
        assets.apply(batch, rows)
        ips.apply(batch, spark.createDataFrame(ips_before, addresses.schema))
    assert {(r.asset_id, r.source, r.create_person, r.node_id) for r in assets.read().collect()} >= {("own", "2", "dev1", "1")}
    assert {(r.ip_addr, r.mac_addr, r.group_id) for r in ips.read().collect()} == {("10.9.0.1", "00-11-22-33-44-55", "1"), ("10.9.0.2", "", "1")}
