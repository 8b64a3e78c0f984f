"""The retry loop over stored quarantine (STR-12, DOM-28, SRC-05, SNK-07).

Standard events whose internal addresses no asset has yet wait as Parquet below ``attempt=0``.
A run takes what is new below each attempt with ``availableNow``, the highest attempt first, so that no
event is tried twice in a run.  A try looks both endpoints up again and rebuilds their asset blocks
inside the event.  Events with all internal endpoints resolved leave by their verdict, which
is read from the nested block; the others move to the next attempt, and behind the last one they are dead.

What a try decided is stored before anything follows from it.  A batch that comes again after a crash finds its
decision and repeats only the writes that are missing, even if the assets have changed meanwhile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import standard_event as SE
from ..functions import net as N
from ..functions.template import Each, build
from ..operators import quality as Q
from ..storage import exists, write_once

SIDES = ("source_endpoint", "purpose_endpoint")


def _address(side: str) -> Column:
    return F.col(f"event.threat_info.{side}.ip_info.ip")


def _asset_block(found: Column) -> Column:
    d = found["detail"]
    some = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.array(c))
    return build(SE.ASSET, {
        "asset_id": found["asset_id"], "os": found["os"], "unit": found["unit"], "ip_group": Each(d["ip_group"], lambda x: {"ip": x["ip"], "mac": x["mac"]}, or_default=True),
        "network_struct": some(d["network"]), "type": d["type"], "asset_level": d["asset_level"], "people.user": d["user"], "people.manager": d["manager"],
        "applications": d["applications"]})


def unresolved(events: DataFrame) -> Column:
    """An event that has to wait: an internal endpoint without an asset."""
    missing = [N.is_private(_address(s)) & (F.col(f"event.threat_info.{s}.asset_detail.asset_id") == "") for s in SIDES]
    return F.coalesce(missing[0], F.lit(False)) | F.coalesce(missing[1], F.lit(False))


def with_profiles(events: DataFrame, details: DataFrame) -> DataFrame:
    """The events with the asset blocks of both endpoints as the asset tables have them now, and ``_ok``."""
    out = events
    for side in SIDES:
        found = details.select(F.col("ip_addr").alias("_ip"), F.struct("asset_id", F.col("os_ver").alias("os"), "unit", "detail").alias("_found"))
        key = F.when(N.is_private(_address(side)), _address(side))
        out = out.withColumn("_key", key).join(found, F.col("_key") == F.col("_ip"), "left")
        block = F.when(F.col("_found.asset_id").isNotNull(), _asset_block(F.col("_found"))).otherwise(F.col(f"event.threat_info.{side}.asset_detail"))
        out = out.withColumn("event", F.col("event").withField(f"threat_info.{side}.asset_detail", block)).drop("_key", "_ip", "_found")
    return out.withColumn("_ok", ~unresolved(out))


class RetryLoop:
    def __init__(self, spark: SparkSession, root: str, checkpoints: str, max_attempts: int):
        self.spark, self.root, self.checkpoints, self.max_attempts = spark, root.rstrip("/"), checkpoints.rstrip("/"), max_attempts

    def folder(self, kind: str, *parts: str) -> str:
        return "/".join([self.root, kind, *parts])

    def admit(self, events: DataFrame, batch: int) -> None:
        """Events of a standardisation batch that have to wait; a replay admits none twice."""
        write_once(events.where(unresolved(events)), self.folder("waiting", "attempt=0", f"from=flow-{batch}"))

    def run(self, details: DataFrame) -> None:
        """One try of everything that waits."""
        for attempt in range(self.max_attempts - 1, -1, -1):
            waiting = self.folder("waiting", f"attempt={attempt}")
            if not exists(self.spark, waiting):
                continue
            rows = self.spark.read.option("recursiveFileLookup", "true").parquet(waiting)
            stream = self.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(waiting)
            query = (stream.writeStream.foreachBatch(lambda b, k, n=attempt: self._try(b, k, n, details))
                     .option("checkpointLocation", f"{self.checkpoints}/attempt={attempt}").trigger(availableNow=True).start())
            query.awaitTermination()

    def _try(self, batch: DataFrame, batch_id: int, attempt: int, details: DataFrame) -> None:
        own = f"from={attempt}-{batch_id}"
        tried = Q.retry(batch.withColumn("attempt", F.lit(attempt)), lambda rows: with_profiles(rows, details), self.max_attempts)
        tried = tried.withColumn("route", Q.nested_verdict(tried, "event.Used_by_ES_ExtendInfo"))
        tried = write_once(tried, self.folder("decided", own))
        kept = [c for c in batch.columns if c != "attempt"]
        write_once(tried.where("outcome = 'recovered'").select(*kept, "attempt"), self.folder("recovered", own))
        write_once(tried.where("outcome = 'dead'").select(*kept, "attempt"), self.folder("dead", own))
        if attempt + 1 < self.max_attempts:
            write_once(tried.where("outcome = 'requeued'").select(*kept), self.folder("waiting", f"attempt={attempt + 1}", own))

    def read(self, kind: str) -> DataFrame:
        """Stored rows: ``recovered`` or ``dead``, or ``waiting`` at any attempt."""
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.folder(kind))
