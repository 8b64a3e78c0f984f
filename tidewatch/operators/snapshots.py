"""Versioned tables that upserts maintain (UPS-01/04/05/22/25/26/27).

A table is a series of versions, each a bucketed table of the shared warehouse, clustered and sorted
by the business key.  An upsert joins the newest version with one batch's changes: the snapshot's
buckets are the join's partitions, so only the changes are shuffled, and every task writes the one
bucket that it holds.  A manifest has one entry for each version, with the batches that went into it.  The
entry is written last; a batch that is in the manifest changes nothing when it comes again, and a version
without an entry doesn't exist.  One writer at a time.

Rows without a key can't be found again: changes with a null in their key are returned by ``unkeyed``
and not merged.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.plan import bind
from . import upsert as U


class SnapshotTable:
    def __init__(self, spark: SparkSession, name: str, root: str, schema: str, keys: Sequence[str], update: Sequence[str],
                 newest_first: Sequence[str] = (), defaults: dict[str, Column] | None = None, buckets: int = 64):
        """``root``: the folder of all versions and the manifest; ``update``: columns that a change sets;
        ``newest_first``: columns of the changes that say which change of a key is the last."""
        self.spark, self.name, self.root, self.schema = spark, name, root.rstrip("/"), schema
        self.keys, self.update, self.newest_first, self.defaults, self.buckets = list(keys), list(update), list(newest_first), defaults, buckets

    # --- manifest ---------------------------------------------------------------------------

    def _entries(self) -> list[dict]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = [s.getPath().toString() for s in fs.listStatus(path) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        if not done:
            return []
        return sorted((json.loads(r.value) for r in self.spark.read.text(done).select("value").collect()), key=lambda e: e["version"])

    def applied(self) -> set:
        """The batches that the newest version holds."""
        return {b for e in self._entries() for b in e["batches"]}

    def version(self) -> int:
        entries = self._entries()
        return entries[-1]["version"] if entries else 0

    # --- versions ---------------------------------------------------------------------------

    def _table(self, entry: dict) -> str:
        """The version's table in this session's catalog, whichever session wrote it."""
        name = f"{self.name}_{entry['id']}"
        if not self.spark.catalog.tableExists(name):
            by = ", ".join(f"`{k}`" for k in self.keys)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._type().fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {entry['buckets']} BUCKETS LOCATION '{entry['path']}'")
        return name

    def _type(self) -> StructType:
        return self.spark.createDataFrame([], self.schema).schema

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the newest one."""
        entries = [e for e in self._entries() if version is None or e["version"] == version]
        return self.spark.table(self._table(entries[-1])) if entries else self.spark.createDataFrame([], self.schema)

    def unkeyed(self, changes: DataFrame) -> DataFrame:
        return changes.where(" OR ".join(f"`{k}` IS NULL" for k in self.keys))

    def merged(self, changes: DataFrame) -> DataFrame:
        """The next version: the newest one with ``changes``, and ``_op``."""
        entries = self._entries()
        return self.merge(self.read(), changes, entries[-1]["buckets"] if entries else self.buckets)

    def merge(self, snapshot: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
        """Any rows of this table's columns as the snapshot, and the last change of each key."""
        keyed = changes.where(" AND ".join(f"`{k}` IS NOT NULL" for k in self.keys))
        if self.newest_first:
            keyed = U.latest_per_key(keyed, self.keys, self.newest_first)
            keyed = keyed.drop(*[c for c in self.newest_first if c not in (*self.keys, *self.update)])
        # bound, so that a key that is the same in all changes stays a part of the join's key, as it is of the buckets'
        keyed = bind(keyed, **{k: F.col(k) for k in self.keys})
        return U.upsert(snapshot, keyed.repartition(buckets, *self.keys), self.keys, self.update, self.defaults)

    def apply(self, batch, changes: DataFrame) -> dict:
        """Merges the changes of ``batch`` once and returns the manifest's entry for the batch."""
        entries = self._entries()
        for e in entries:
            if batch in e["batches"]:
                return e
        own = uuid.uuid4().hex
        entry = {"version": entries[-1]["version"] + 1 if entries else 1, "batches": [batch], "id": own, "path": f"{self.root}/{own}",
                 "buckets": entries[-1]["buckets"] if entries else self.buckets}
        rows = self.merged(changes).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self._type().fields))
        (rows.write.bucketBy(entry["buckets"], *self.keys).sortBy(*self.keys).option("path", entry["path"]).format("parquet")
         .saveAsTable(f"{self.name}_{own}"))
        line = self.spark.createDataFrame([(json.dumps(entry),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self.root}/manifest/version={entry['version']}")
        return entry


# --- the maintained tables --------------------------------------------------------------------

def org_node_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-01: organisation nodes; a report sets a node's name and parent."""
    return SnapshotTable(spark, "org_node", root, "node_id string, node_name string, parent_node_id string, node_type_id string", ["node_id"],
                         ["node_name", "parent_node_id", "node_type_id"], ["timestamp", "offset"], **options)


def source_record_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-04: which asset an agent's id stands for, by source."""
    return SnapshotTable(spark, "source_record", root, "map_asset_id string, asset_source string, first_asset_id string", ["map_asset_id", "asset_source"],
                         ["first_asset_id"], ["timestamp", "offset"], **options)


def server_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-05: endpoint servers with their last address and report."""
    return SnapshotTable(spark, "endpoint_server", root, "server_uid string, server_ip string, last_report timestamp", ["server_uid"],
                         ["server_ip", "last_report"], ["last_report", "offset"], **options)


def device_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-27: devices by type, with their last report; ``device_types`` names the types (UPS-26)."""
    return SnapshotTable(spark, "device", root, "device_id string, device_type_id string, last_seen timestamp", ["device_id", "device_type_id"], ["last_seen"], ["last_seen"], **options)


def device_type_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-26: the types of devices."""
    return SnapshotTable(spark, "device_type", root, "device_type_id string, device_type string", ["device_type_id"], ["device_type"], **options)


ASSET = ("asset_id string, node_id string, type_id string, asset_level string, asset_name string, asset_label string, source string, create_person string, "
         "use_person string, register_state string, delete_state string, fall_state string")


def asset_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-22 / UPS-25: assets; a later report of a known asset sets its name and person only."""
    insert = {c: F.col(f"c_{c}") for c in (x.split()[0] for x in ASSET.split(", ")) if c not in ("asset_id", "asset_name", "use_person")}
    return SnapshotTable(spark, "asset", root, ASSET, ["asset_id"], ["asset_name", "use_person"], defaults=insert, **options)


def asset_ip_table(spark: SparkSession, root: str, **options) -> SnapshotTable:
    """UPS-22 / UPS-25: addresses of assets."""
    return SnapshotTable(spark, "asset_ip", root, "asset_id string, ip_addr string, mac_addr string, group_id string", ["asset_id", "ip_addr"], ["mac_addr", "group_id"], **options)
