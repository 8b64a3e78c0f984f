"""Following a log that grows, rotates and restarts: no line twice, none lost."""

import os
import random

from tidewatch.streaming import logfollow as L


def follow(spark, folder, checkpoint, sink, **options):
    """Takes what is there, then stops, as a job that is started again and again."""
    spark.dataSource.register(L.LogFollower)
    r = spark.readStream.format("log_follow").option("path", str(folder)).option("name", "app.log")
    for k, v in options.items():
        r = r.option(k, v)
    q = (r.load().writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(checkpoint)).start())
    q.processAllAvailable()
    q.stop()
    return sorted((x.segment, x.offset, x.line) for x in spark.read.parquet(str(sink)).collect())


def append(folder, text):
    with open(folder / "app.log", "a", encoding="utf-8", newline="") as f:
        f.write(text)


def test_grow_rotate_restart(spark, tmp_path):
    log, ck, out = tmp_path / "log", tmp_path / "ck", tmp_path / "out"
    log.mkdir()
    append(log, "one\ntwo\nthr")
    assert [x[2] for x in follow(spark, log, ck, out)] == ["one", "two"]
    append(log, "ee\r\nfour\nlast without end")
    os.rename(log / "app.log", log / "app.log-20240101")
    append(log, "five\nsi")
    (log / "other.log").write_text("not this one\n")
    rows = follow(spark, log, ck, out)
    assert sorted(x[2] for x in rows) == sorted(["one", "two", "three", "four", "last without end", "five"])
    assert len({x[0] for x in rows}) == 2
    append(log, "x\n")
    os.rename(log / "app.log", log / "app.log-20240102")
    assert [x[2] for x in follow(spark, log, ck, out) if x[2] == "six"] == ["six"]
    append(log, "")
    rows = follow(spark, log, ck, out)  # nothing new
    assert len(rows) == 7


def test_a_segment_of_one_open_line(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    append(log, "only")
    assert not follow_empty(spark, log, tmp_path)
    os.rename(log / "app.log", log / "app.log-20240101")
    append(log, "next\n")
    assert sorted(x[2] for x in follow(spark, log, tmp_path / "ck", tmp_path / "out")) == ["next", "only"]


def follow_empty(spark, log, tmp_path):
    return L.LogStream({"path": str(log), "name": "app.log"}).latestOffset()


def test_segments_that_begin_alike(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    append(log, "start\na\n")
    os.rename(log / "app.log", log / "app.log-20240101")
    append(log, "start\nb\n")
    assert sorted(x[2] for x in follow(spark, log, tmp_path / "ck", tmp_path / "out")) == ["a", "b", "start", "start"]
    os.rename(log / "app.log", log / "app.log-20240102")
    append(log, "start\nc\n")
    assert sorted(x[2] for x in follow(spark, log, tmp_path / "ck", tmp_path / "out")) == ["a", "b", "c", "start", "start", "start"]


def test_ranges_cut_anywhere(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rng = random.Random(1)
    lines = ["é" * rng.randrange(0, 30) + str(k) for k in range(400)]
    want = []
    for k in range(0, 400, 100):
        append(log, "".join(x + "\n" for x in lines[k:k + 100]))
        want += lines[k:k + 100]
        got = follow(spark, log, tmp_path / "ck", tmp_path / "out", bytesPerRange=17)
        assert [x[2] for x in sorted(got, key=lambda x: x[1])] == want


def test_listing(tmp_path):
    for n in ("app.log", "app.log-20240105", "app.log-20231231", "app.log-2024", "app.logx", "zapp.log"):
        (tmp_path / n).write_text(f"{n}\n")
    (tmp_path / "app.log-20231230").write_text("no end")
    assert [os.path.basename(p) for _, p in L.segments(str(tmp_path), "app.log")] == ["app.log-20231230", "app.log-20231231", "app.log-20240105", "app.log"]
    assert L.segments(str(tmp_path / "none"), "app.log") == []
