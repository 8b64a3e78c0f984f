"""Streaming twins must equal their batch queries (file source + availableNow)."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidewatch.operators import firewall as fw
from tidewatch.sources import derive
from tidewatch.streaming import pipelines as P

from .conftest import SF001


def _write_topic(spark, df, path, parts=4):
    (df.select("topic", "partition", "offset", "timestamp", "value").repartition(parts)
     .write.mode("overwrite").json(path))


def test_stream_day_counters_equal_batch(spark, tmp_path):
    topic = derive.firewall_topic(derive.table(spark, SF001, "events"))
    src = str(tmp_path / "fw")
    _write_topic(spark, topic, src)
    stream = P.firewall_day_counters(P.file_topic_stream(spark, src, max_files_per_trigger=1))
    q = (stream.writeStream.format("memory").queryName("fw_day_counters").outputMode("complete")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("fw_day_counters").collect())
    want = sorted(tuple(r) for r in fw.vendor_daily_counts(fw.run(topic)).select(
        "vendor", "day", "origin_count", "black_count", "accepted_count").collect())
    assert got == want


def test_stream_dedupe(spark, tmp_path):
    rows = [{"topic": "t", "partition": 0, "offset": i % 5, "timestamp": "2024-01-01T00:00:00", "value": "v"}
            for i in range(20)]
    src = tmp_path / "dup"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    q = (P.dedupe(P.file_topic_stream(spark, str(src))).writeStream.format("memory").queryName("dedup")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("dedup").count() == 5


def test_presence_state_times_out(spark, tmp_path):
    src = tmp_path / "seen"
    src.mkdir()
    t0 = dt.datetime(2024, 1, 1)
    batches = [[("ptd", "A", t0), ("ptd", "B", t0)], [("ptd", "B", t0 + dt.timedelta(hours=6))],
               [("ptd", "B", t0 + dt.timedelta(hours=7))]]
    for i, b in enumerate(batches):
        f_ = src / f"{i}.json"
        f_.write_text("\n".join(json.dumps({"family": f, "device": d, "ts": t.isoformat()}) for f, d, t in b))
        os.utime(f_, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))   # arrival order = file order
    stream = spark.readStream.schema("family string, device string, ts timestamp") \
        .option("maxFilesPerTrigger", 1).json(str(src))
    q = (P.device_presence(stream).writeStream.format("memory").queryName("presence").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    rows = spark.table("presence").collect()
    b = [r for r in rows if r["device"] == "B"]
    assert max(r["last_seen"] for r in b) == t0 + dt.timedelta(hours=7)
    assert min(r["first_seen"] for r in b) == t0
    a = [r for r in rows if r["device"] == "A"]
    assert any(r["online"] for r in a)
    assert any(not r["online"] for r in a)     # silent longer than the window -> offline row


def test_routed_writer_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("black", "2024-01-01", 1), ("white", "2024-01-01", 2)], "route string, dt string, x int")
    w = P.routed_writer(str(tmp_path / "out"))
    w(df, 7)
    w(df, 7)                                    # replay of the same batch id rewrites, never duplicates
    assert spark.read.parquet(str(tmp_path / "out" / "batch_id=7")).count() == 2


def test_pair_file_streams(spark, tmp_path):
    x = tmp_path / "x"
    c = tmp_path / "c"
    x.mkdir()
    c.mkdir()
    (x / "a.json").write_text(json.dumps({"stem": "s1", "xml_time": "2024-01-01T00:00:00", "taskid": "t"}) + "\n" +
                              json.dumps({"stem": "s2", "xml_time": "2024-01-01T00:00:00", "taskid": "u"}))
    (c / "a.json").write_text(json.dumps({"stem": "s1", "pcap_time": "2024-01-01T00:10:00", "pcap_path": "p"}))
    xs = spark.readStream.schema("stem string, xml_time timestamp, taskid string").json(str(x))
    cs = spark.readStream.schema("stem string, pcap_time timestamp, pcap_path string").json(str(c))
    q = (P.pair_file_streams(xs, cs).writeStream.format("memory").queryName("pairs")
         .option("checkpointLocation", str(tmp_path / "ck4")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert [(r["stem"], r["pcap_path"]) for r in spark.table("pairs").collect()] == [("s1", "p")]


def test_archive_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("k1", "v1", "2024-01-01 10:00:00"), ("k2", "v2", "2024-01-02 10:00:00")],
                               "rowkey string, value string, ts string").withColumn("timestamp", F.col("ts").cast("timestamp"))
    P.archive(df, str(tmp_path / "arc"), "syslog")
    P.archive(df, str(tmp_path / "arc"), "ptd")
    back = spark.read.parquet(str(tmp_path / "arc"))
    assert back.count() == 4
    assert back.filter("source = 'ptd' AND dt = DATE'2024-01-02'").select("payload").first()[0] == "v2"


def test_sensor_flow_per_micro_batch_equals_batch(spark, tmp_path):
    from tidewatch.operators import sensor as S

    topic = derive.sensor_topic(derive.table(spark, SF001, "events"))
    src = str(tmp_path / "ptd")
    _write_topic(spark, topic, src)

    def flow(df):
        return S.standardise(df).select("id", "route", "threat_flag", "timestamp")

    q = P.standardise_stream(P.file_topic_stream(spark, src, max_files_per_trigger=2), flow,
                             str(tmp_path / "out"), str(tmp_path / "ck5")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "route", "threat_flag")
    want = flow(topic).select("id", "route", "threat_flag")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
