"""Lifetime counters as state: equal to the batch result, whatever comes late or twice."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import firewall as fw
from tidewatch.sources import derive
from tidewatch.streaming import lifetime as LT

from .conftest import SF001


@pytest.fixture
def rocks(spark):
    old = {k: spark.conf.get(k, None) for k in LT.STATE_CONF}
    for k, v in LT.STATE_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def messages(spark):
    c = fw.run(derive.firewall_topic(derive.table(spark, SF001, "events")).where("offset < 40"))
    return c.where("vendor IS NOT NULL AND host IS NOT NULL").select(
        F.col("vendor").alias("family"), F.col("host").alias("device"), F.date_trunc("second", "timestamp").alias("ts"), (F.col("black") != 0).alias("black"), "accepted", "topic", "partition", "offset")


def batch(rows):
    return rows.groupBy("family", "device").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("origin_count"),
                                                F.count_if("black").alias("black_count"), F.count_if("accepted").alias("accepted_count"))


def state(spark, folder):
    """The last row of each device."""
    out = {}
    for r in spark.read.parquet(f"{folder}/*").collect():
        old = out.get((r.family, r.device))
        if old is None or r.origin_count >= old[2]:
            out[r.family, r.device] = (r.first_seen, r.last_seen, r.origin_count, r.black_count, r.accepted_count)
    return out


def run(spark, src, checkpoint, folder, initial=None):
    stream = spark.readStream.schema(LT.INPUT).option("maxFilesPerTrigger", 1).json(src)
    q = (LT.lifetime_counters(stream, initial).writeStream.foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{folder}/{k}")).outputMode("update").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(600)


def want(rows):
    return {(r.family, r.device): tuple(r)[2:] for r in batch(rows).collect()}


def test_state_equals_the_batch_also_with_late_and_repeated_rows(spark, tmp_path, rocks):
    rows = messages(spark).cache()
    src = str(tmp_path / "in")
    newest = rows.agg(F.expr("percentile(unix_timestamp(ts), 0.5)")).first()[0]
    # the newer half first, the older half late; then everything again
    rows.where(F.unix_timestamp("ts") > newest).coalesce(1).write.mode("append").json(src)
    rows.where(F.unix_timestamp("ts") <= newest).withColumn("partition", F.col("partition") + 100).coalesce(1).write.mode("append").json(src)
    run(spark, src, str(tmp_path / "ck"), str(tmp_path / "a"))
    assert state(spark, str(tmp_path / "a")) == want(rows)
    rows.where(F.unix_timestamp("ts") > newest).coalesce(1).write.mode("append").json(src)
    run(spark, src, str(tmp_path / "ck"), str(tmp_path / "b"))  # goes on from the checkpoint; a repeated delivery
    assert state(spark, str(tmp_path / "b")).items() <= want(rows).items()
    rows.unpersist()


def test_the_archive_is_the_initial_state(spark, tmp_path, rocks):
    rows = messages(spark).cache()
    old, new = rows.where("offset < 20"), rows.where("offset >= 20")
    src = str(tmp_path / "in")
    new.coalesce(1).write.json(src)
    run(spark, src, str(tmp_path / "ck"), str(tmp_path / "c"), initial=batch(old))
    expected = want(rows)
    assert state(spark, str(tmp_path / "c")) == {k: expected[k] for k in want(new)}
    rows.unpersist()
