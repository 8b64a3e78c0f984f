"""File sources (SRC-08..12) on real files; endpoint decode / allow-list / split (SRC-02,
STR-02, FLT-12, DOM-22)."""

import json
import os

from pyspark.sql import functions as F

from tidewatch.config import EngineParams
from tidewatch.operators import endpoint as EP
from tidewatch.operators import sidefeeds as SF
from tidewatch.sources import files as FS


def test_drop_folder_pairs_real_files(spark, tmp_path):
    d = tmp_path / "drop" / "a"
    d.mkdir(parents=True)
    (d / "cap1.xml").write_text("<task><FILENAME>cap1.pcap</FILENAME><TASKID>t1</TASKID></task>")
    (d / "cap1.pcap").write_bytes(b"\x00\x01")
    (d / "cap2.xml").write_text("<task><FILENAME>cap2.pcap</FILENAME><TASKID>t2</TASKID></task>")
    for f in d.iterdir():
        os.utime(f, (1_600_000_000, 1_600_000_000))
    listing = FS.drop_folder_listing(spark, str(tmp_path / "drop"), min_age_seconds=20)
    assert listing.count() == 3
    files = FS.xml_files(spark, str(tmp_path / "drop")).unionByName(
        FS.capture_files(spark, str(tmp_path / "drop")).select("path", F.lit(None).cast("string").alias("content")))
    pairs = SF.pair_files(files).collect()
    assert [(r["filename"], r["taskid"]) for r in pairs] == [("cap1.pcap", "t1")]


def test_newest_rotated_segment(spark, tmp_path):
    for day, lines in (("20240101", ["a", "b"]), ("20240103", ["c"]), ("20240102", ["d"])):
        (tmp_path / f"app.log-{day}").write_text("\n".join(lines))
    newest = FS.newest_segment(FS.log_lines(spark, str(tmp_path)))
    assert [r["line"] for r in newest.collect()] == ["c"]


def _topic(spark, msgs):
    rows = [("iep", 0, i, json.dumps(m) if isinstance(m, dict) else m) for i, m in enumerate(msgs)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string") \
        .withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_endpoint_decode_allow_list_and_split(spark):
    client = {"uuid": "u1", "ip": "10.0.0.1", "server_ip": "192.0.2.1", "server_uid": "s"}
    files = [{"md5": "a", "path": "C:\\x\\a.doc", "malname": "worm/x"}, {"md5": "b", "path": "C:\\x\\b.doc"}]
    msgs = [{"type": "virus_defend", "client": client, "fileinfo": files},
            {"type": "active_protect", "client": dict(client, server_ip="192.0.2.9"), "registry_path": "HKLM\\R"},
            "{not json"]
    t = _topic(spark, msgs)
    t = t.unionByName(t)                                    # re-delivered offsets
    good, bad = EP.decode(t)
    assert good.count() == 2 and bad.count() == 1
    allowed = EP.gate(good, EngineParams(endpoint_server_allow_list=("192.0.2.1",)))
    split = EP.split_files(allowed)
    assert sorted(r["fileinfo"][0]["md5"] for r in split.collect()) == ["a", "b"]


def test_endpoint_legacy_verdicts(spark):
    client = {"uuid": "u1", "ip": "10.0.0.1", "server_ip": "192.0.2.1", "server_uid": "s"}
    t = _topic(spark, [{"type": "active_protect", "client": client, "registry_path": "HKLM\\Run", "malname": "x"},
                       {"type": "proc_protect", "client": client, "child_process_path": "C:\\t\\c.exe"}])
    good, _ = EP.decode(t)
    techniques = spark.createDataFrame([], "attck_id long, attck_content string")
    lookup = spark.createDataFrame([], "ip_addr string, asset_id string")
    r = {x["type"]: x for x in EP.standardise(EP.split_files(good), techniques, lookup).collect()}
    assert (r["active_protect"]["is_malicious"], r["active_protect"]["route"]) == (False, "black")   # Q7
    assert r["active_protect"]["detect_obj"] == "目的载体" and r["active_protect"]["file_name"] == "Run"
    assert r["proc_protect"]["file_name"] == "c.exe" and r["proc_protect"]["asset_known"] is False


def test_routes_match_standardised_routes(spark):
    from tidewatch.plans import endpoint_queries as EQ

    from .conftest import SF001

    events, std, _ = EQ._standardised(spark, SF001)
    a = EP.routes(events).groupBy("route").count()
    b = std.groupBy("route").count()
    assert sorted(a.collect()) == sorted(b.collect())
