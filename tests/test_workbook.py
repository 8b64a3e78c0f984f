"""The report workbook: one aggregate, eight sheets, written once."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import workbook as W

FLOW = "family string, device string, ts timestamp, origin boolean, black boolean"
DAY = dt.date(2024, 1, 2)
AS_OF = dt.datetime(2024, 1, 2, 12)


def at(h, d=2, m=0, s=0):
    return dt.datetime(2024, 1, d, h, m, s)


def lines(spark, flows, beats):
    fig = W.figures([spark.createDataFrame(f, FLOW) for f in flows], spark.createDataFrame(beats, "family string, device string, ts timestamp"), F.lit(DAY))
    return W.sheets(fig, F.lit(AS_OF), {"s1": "North"}, data_minutes=60, heartbeat_minutes=30)


def by_sheet(rows):
    out = {}
    for r in rows:
        out.setdefault(r.sheet, set()).add(tuple(c for c in (r.a, r.b, r.c, r.d) if c is not None))
    return out


def test_sheets(spark, tmp_path):
    firewalls = [("star", "f1", at(11, m=30), True, True), ("star", "f1", at(1), True, False), ("hillstone", "f2", at(2), True, True),
                 ("star", None, at(11, m=59), True, False), ("star", "f1", at(9, d=1), True, True), ("zhenguan", "f3", at(11, m=30), True, True)]
    sensors = [("ptd", "s1", at(10), True, True), ("ptd", "s2", at(11), True, False), ("ptd", None, at(3), True, True)]
    servers = [("iep", "x", at(11, m=0, s=1), True, True), ("iep", "x", at(11, m=0, s=1), False, True)]
    beats = [("ptd", "s1", at(11, m=30)), ("ptd", "s1", at(5)), ("ptd", "s9", at(12)), ("ptd", "s2", at(11, m=29, s=59)), ("iep", "x", at(12, s=1))]
    got = lines(spark, [firewalls, sensors, servers], beats)
    want = {
        "daily": {("启明", "3", "4", "1"), ("山石", "1", "4", "1"), ("IEP", "1", "1", "2"), ("PTD", "3", "3", "2"), ("网闸", "0", "0", "0")},
        # data of exactly an hour ago is too old, a heartbeat of exactly half an hour ago isn't
        "online": {("star", "f1"), ("iep", "x"), ("ptd", "North"), ("ptd", "s9")},
        "iep_data": {("x", "2024-01-02 11:00:01")}, "iep_heartbeat": {("x", "2024-01-02 12:00:01")}, "iep_counts": {("x", "1", "2")},
        "ptd_data": {("North", "2024-01-02 10:00:00"), ("s2", "2024-01-02 11:00:00"), ("", "2024-01-02 03:00:00")},
        "ptd_heartbeat": {("North", "2024-01-02 11:30:00"), ("s2", "2024-01-02 11:29:59"), ("s9", "2024-01-02 12:00:00")},
        "ptd_counts": {("North", "1", "1"), ("s2", "1", "0"), ("", "1", "1")},
    }
    assert by_sheet(got.collect()) == want
    for _ in range(2):   # the second time the folder is there
        frames = W.write_workbook(got, str(tmp_path / "book"))
    assert list(frames) == [title for title, _ in W.SHEETS.values()]
    book = frames["ptd上传日志条数"]
    assert book.columns == ["PTD", "上传总日志条数", "上传黑日志条数"]
    assert {tuple(r) for r in book.collect()} == want["ptd_counts"]
    assert {tuple(r) for r in frames["今日数据日报"].collect()} == want["daily"]


def test_no_rows(spark):
    assert by_sheet(lines(spark, [[]], []).collect()) == {"daily": {(t, "0", "0", "0") for t in W.DAILY.values()}}


def test_one_scan_of_each_flow(spark):
    """Every flow is read once, whatever the number of sheets."""
    flow = spark.range(100).select(F.lit("ptd").alias("family"), F.col("id").cast("string").alias("device"), F.lit(AS_OF).alias("ts"),
                                   F.lit(True).alias("origin"), F.lit(False).alias("black"))
    beats = spark.createDataFrame([], "family string, device string, ts timestamp")
    plan = W.sheets(W.figures([flow], beats, F.lit(DAY)), F.lit(AS_OF), {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") == 1
