"""Snapshot maintenance (WIN-01, UPS-*) and dictionaries (AGG-22)."""

from pyspark.sql import functions as F

from tidewatch.operators import upsert as U
from tidewatch.operators.dictionary import assign_new_ids


def test_latest_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 5, "y"), ("b", 1, 1, "z")],
                               "k string, off int, ts int, v string")
    out = {r["k"]: r["v"] for r in U.latest_per_key(df, ["k"], ["ts", "off"]).collect()}
    assert out == {"a": "y", "b": "z"}


def test_upsert_insert_update_keep_and_null_update(spark):
    snap = spark.createDataFrame([("1", "w", "s1"), ("2", "u", "s2")], "k string, os string, srv string")
    chg = spark.createDataFrame([("2", "c", None), ("3", "n", "s3")], "k string, os string, srv string")
    out = {r["k"]: r for r in U.upsert(snap, chg, ["k"], ["os", "srv"]).collect()}
    assert (out["1"]["os"], out["1"]["_op"]) == ("w", "keep")
    assert (out["2"]["os"], out["2"]["srv"], out["2"]["_op"]) == ("c", None, "update")   # NULL sets NULL
    assert (out["3"]["os"], out["3"]["_op"]) == ("n", "insert")


def test_change_feed(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "k string, v string")
    new = spark.createDataFrame([("1", "a"), ("2", "c"), ("3", None)], "k string, v string")
    assert [(r["k"], r["old"], r["new"]) for r in U.changed(old, new, ["k"], "v").collect()] == [("2", "b", "c")]


def test_assign_new_ids(spark):
    d = spark.createDataFrame([("x", 3), ("y", 7)], "name string, id long")
    seen = spark.createDataFrame([("y",), ("b",), ("a",), ("a",)], "name string")
    assert sorted((r["name"], r["id"]) for r in assign_new_ids(seen, d, "name", "id").collect()) == [("a", 8), ("b", 9)]


def test_snapshot_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a")], "k string, v string")
    p = U.write_snapshot(df, str(tmp_path), "v1")
    assert U.read_snapshot(spark, p).collect()[0]["v"] == "a"
