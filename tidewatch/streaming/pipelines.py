"""Structured Streaming wrappers: the batch operators applied to unbounded topics.

* sources: Kafka when the connector is on the classpath (untested here -- no broker and no
  connector jar in this environment), JSON / text files otherwise; both yield the same
  ``(topic, partition, offset, timestamp, value)`` frame the batch operators take;
* STR-02: re-delivered messages dropped with ``dropDuplicatesWithinWatermark``;
* STR-09: running day counters as event-time windows with a watermark (bounded state);
* STR-05 / STR-06: device first / last seen kept in keyed state with an event-time timeout
  that marks a device offline once it has been silent for the presence window;
* STR-10: two-sided file arrival as a stream-stream join bounded by watermarks;
* sinks: ``foreachBatch`` writes that are idempotent per batch id (route split, archive,
  quarantine), checkpoints in the folder the caller names.

Every watermark is a parameter.  It bounds the state, and rows that come later than it are left
out of the streamed counters and pairs (Spark has no output for them): choose it above the longest
delay of the sources.  ``late_rows`` picks such rows from a micro-batch for the quarantine, and the batch
queries over the archive count them in any case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import endpoint as EP
from ..operators import endpoint_event as EE
from ..operators import firewall as fw
from ..operators.dictionary import Ledger

TOPIC_SCHEMA = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING"


# --- sources -------------------------------------------------------------------------------

def kafka_topic_stream(spark: SparkSession, servers: str, topic: str,
                       max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source in the engine's topic shape (requires the Kafka connector).  A trigger
    takes all that has arrived unless the caller bounds it."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_offsets_per_trigger is not None:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    r = r.load()
    return r.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))


def file_topic_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """JSON-lines files holding topic records (one object per message)."""
    return (spark.readStream.schema(TOPIC_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(path))


def dedupe(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """STR-02: drop re-delivered (topic, partition, offset) within the watermark."""
    return stream.withWatermark("timestamp", watermark) \
        .dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


# --- STR-09 ----------------------------------------------------------------------------------

def firewall_day_counters(topic_stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Per vendor and event day: messages, black-listed, accepted -- the streaming twin of
    ``fw_vendor_daily``; the watermark bounds the open windows kept in state."""
    c = fw.run(topic_stream).filter(F.col("vendor").isNotNull())
    return (c.withWatermark("timestamp", watermark)
            .groupBy("vendor", F.window("timestamp", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("origin_count"), F.sum("black").cast("long").alias("black_count"),
                 F.sum(F.col("accepted").cast("int")).cast("long").alias("accepted_count"))
            .select("vendor", F.to_date(F.col("w.start")).alias("day"), "origin_count", "black_count",
                    "accepted_count"))


# --- STR-05 / STR-06 -------------------------------------------------------------------------

SEEN_OUT = "family STRING, device STRING, first_seen TIMESTAMP, last_seen TIMESTAMP, online BOOLEAN"
SEEN_STATE = "first_seen TIMESTAMP, last_seen TIMESTAMP, online BOOLEAN"


def _seen_fn(window_ms: int) -> Callable:
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        family, device = key
        if state.hasTimedOut:
            first, last, _ = state.get
            state.update((first, last, False))  # a device that returns keeps its first report
            yield pd.DataFrame({"family": [family], "device": [device], "first_seen": [first],
                                "last_seen": [last], "online": [False]})
            return
        first, last, _ = state.get if state.exists else (None, None, False)
        for pdf in pdfs:
            lo, hi = pdf["ts"].min(), pdf["ts"].max()
            first = lo if first is None or lo < first else first
            last = hi if last is None or hi > last else last
        state.update((first, last, True))
        state.setTimeoutTimestamp(int(pd.Timestamp(last).timestamp() * 1000) + window_ms)
        yield pd.DataFrame({"family": [family], "device": [device], "first_seen": [first],
                            "last_seen": [last], "online": [True]})
    return fn


def device_presence(seen_stream: DataFrame, window_minutes: int = 240, watermark: str = "1 hour") -> DataFrame:
    """Keyed state per (family, device): first / last report; a device goes offline (one
    row with ``online = false``) once the event-time watermark passes last + window.  The
    state stays, so the first report of a device that comes back is not lost; it is one row
    per device ever seen.  Input columns: family, device, ts."""
    return (seen_stream.withWatermark("ts", watermark).groupBy("family", "device")
            .applyInPandasWithState(_seen_fn(window_minutes * 60 * 1000), SEEN_OUT, SEEN_STATE, "update",
                                    GroupStateTimeout.EventTimeTimeout))


# --- STR-10 ----------------------------------------------------------------------------------

def pair_file_streams(xml_meta: DataFrame, captures: DataFrame, within: str = "1 hour") -> DataFrame:
    """Metadata and capture of one stem, each arriving as its own stream; the watermark on
    both sides bounds the join state (the reference keeps an unbounded dict)."""
    x = xml_meta.withWatermark("xml_time", within).alias("x")
    c = captures.withWatermark("pcap_time", within).alias("c")
    cond = F.expr(f"x.stem = c.stem AND c.pcap_time BETWEEN x.xml_time - INTERVAL {within} "
                  f"AND x.xml_time + INTERVAL {within}")
    return x.join(c, cond).select("x.*", "c.pcap_path", "c.pcap_time")


def pair_or_quarantine(xml_meta: DataFrame, captures: DataFrame, within: str = "1 hour") -> DataFrame:
    """STR-10 without loss: the pairs, and each half that found no partner, once the watermark says that none
    can come, with the ``reason`` for the quarantine (null for a pair).  Halves further apart than ``within`` are two
    such rows.  The result goes to an append sink; the state holds what lies within the watermark."""
    x = xml_meta.withWatermark("xml_time", within).alias("x")
    c = captures.withWatermark("pcap_time", within).alias("c")
    cond = F.expr(f"x.stem = c.stem AND c.pcap_time BETWEEN x.xml_time - INTERVAL {within} "
                  f"AND x.xml_time + INTERVAL {within}")
    reason = F.when(F.col("c.stem").isNull(), "no_capture").when(F.col("x.stem").isNull(), "no_metadata")
    rest = [F.col(f"x.{n}") for n in xml_meta.columns if n != "stem"]
    return x.join(c, cond, "fullOuter").select(F.coalesce("x.stem", "c.stem").alias("stem"), *rest, "c.pcap_path", "c.pcap_time", reason.alias("reason"))


# --- sinks -----------------------------------------------------------------------------------

def late_rows(batch: DataFrame, newest_before, bound: str, ts_col: str = "timestamp") -> DataFrame:
    """Rows of a micro-batch that are older than ``bound`` before the newest time of all earlier
    batches, with a reason: what a watermark of that bound leaves out."""
    limit = F.lit(newest_before).cast("timestamp") - F.expr(f"INTERVAL {bound}")
    return batch.filter(F.col(ts_col) < limit).withColumn("reason", F.lit("late"))


def routed_writer(out_root: str, route_col: str = "route", partition_cols: tuple[str, ...] = ("dt",)):
    """SNK-02 / SNK-03: ``foreachBatch`` function writing one micro-batch, partitioned by
    route and day, to ``out_root/batch_id=<id>`` (overwrite: a replayed batch id rewrites
    the same files, so delivery is effectively exactly-once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").partitionBy(route_col, *partition_cols)
         .parquet(f"{out_root.rstrip('/')}/batch_id={batch_id}"))
    return write


def archive(df: DataFrame, path: str, source: str, ts_col: str = "timestamp", batch_id: int | None = None) -> None:
    """SNK-03: raw messages as (rowkey, payload) partitioned by day and source.  The key is the
    message's own, else its place in its topic, else the digest of its text and time.  With a
    ``batch_id`` a replayed batch rewrites its own files; without one, rows are appended."""
    if "rowkey" in df.columns:
        key = F.col("rowkey")
    elif {"topic", "partition", "offset"} <= set(df.columns):
        key = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    else:
        key = F.md5(F.concat_ws("|", F.col(ts_col).cast("string"), "value"))
    rows = df.select(key.alias("rowkey"), F.col("value").alias("payload"), F.to_date(ts_col).alias("dt"), F.lit(source).alias("source"))
    if batch_id is None:
        rows.write.mode("append").partitionBy("dt", "source").parquet(path)
    else:
        rows.write.mode("overwrite").partitionBy("dt", "source").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def quarantine(df: DataFrame, path: str, reason: str, batch_id: int) -> None:
    """SNK-05: rejected rows with their reason, in the batch's own folder (a replay rewrites it)."""
    out = df if "reason" in df.columns else df.withColumn("reason", F.lit(reason))
    out.write.mode("overwrite").partitionBy("reason").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


# --- flows driven per micro-batch ------------------------------------------------------------

def standardise_stream(topic_stream: DataFrame, flow: Callable[..., DataFrame], out_root: str,
                       checkpoint: str, partition_cols: tuple[str, ...] = ("dt",), numbered: bool = False):
    """Run a batch flow (sensor or endpoint standardisation -- anything that maps a topic
    frame to rows with a ``route`` column and a ``timestamp``) on every micro-batch and
    write it routed by verdict and day.  The same operator code serves batch and stream;
    ``foreachBatch`` lets the flow use joins with static dimensions and writes that a plain
    streaming sink would not allow.  A ``numbered`` flow gets the batch id as well."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = (flow(batch, batch_id) if numbered else flow(batch)).withColumn("dt", F.to_date("timestamp"))
        routed_writer(out_root, "route", partition_cols)(out, batch_id)
    return topic_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def endpoint_flow(ledger: Ledger, details: DataFrame, gate: Callable[[DataFrame], DataFrame] = lambda d: d) -> Callable[[DataFrame, int], DataFrame]:
    """The endpoint standardisation of one micro-batch, for ``standardise_stream(..., numbered=True)``: unseen
    techniques get their ids from ``ledger`` under the batch's id, and the batch sees the claims up to its own, so
    that a replay writes the same events."""
    def flow(batch: DataFrame, batch_id: int) -> DataFrame:
        events = gate(EP.decode(batch)[0])
        ledger.claim(EP.seen_techniques(events), batch_id, "attck_content")
        known = ledger.read(until=batch_id).select(F.col("id").alias("attck_id"), F.col("name").alias("attck_content"))
        std = EP.standardise(EP.split_files(events), known, details)
        return EE.standard_event(std, "timestamp")
    return flow
