"""CMDB synchronisation: category roots, asset page sync, label dictionary.

Covers SRC-18, FLT-23, FLT-29, UPS-25, AGG-21, UPS-23.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dictionary import assign_new_ids

PAGE_SCHEMA = "pageData ARRAY<STRUCT<cmdb_ip: STRING, cmdb_name: STRING, cmdb_zrr_id_value: STRING>>"
CATEGORY_SCHEMA = "id STRING, parent_id STRING"


def category_roots(categories: DataFrame) -> DataFrame:
    """FLT-23: top-level categories = those whose parent is not itself a category (a left
    anti self join).  Q13, a fix: the source's filter depends on the order of its list and keeps a
    category again whose parent was left out, so from the third level on it keeps
    grandchildren as if they were roots; here they never are."""
    ids = categories.select(F.col("id").alias("parent_id")).distinct()
    return categories.join(ids, "parent_id", "left_anti").select("id", "parent_id")


def pages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC-18: CMDB asset pages (``{"pageData": [...]}`` JSON) -> one row per asset."""
    p = raw.select(F.explode(F.from_json(F.col(value_col), PAGE_SCHEMA)["pageData"]).alias("a"))
    return p.select("a.*")


def sync(cmdb_assets: DataFrame, asset_ips: DataFrame) -> DataFrame:
    """UPS-25 / FLT-29: rows without an address are skipped; an address already owned by an
    asset updates that asset's name and person; any other address inserts a new asset
    (asset row + ip row + source record), with a deterministic id."""
    known = asset_ips.groupBy("ip_addr").agg(F.min("asset_id").alias("_aid"))
    c = cmdb_assets.withColumn("_ip", F.coalesce(F.col("cmdb_ip"), F.lit("")))
    j = c.join(known, c["_ip"] == known["ip_addr"], "left")
    action = (F.when(F.col("_ip") == "", "skipped").when(F.col("_aid").isNotNull(), "updated")
               .otherwise("inserted"))
    asset_id = F.when(F.col("_ip") == "", F.lit(None)).otherwise(
        F.coalesce("_aid", F.upper(F.md5(F.concat(F.lit("cmdb"), F.col("_ip"))))))
    return j.select(F.col("cmdb_ip"), F.col("cmdb_name").alias("asset_name"),
                    F.col("cmdb_zrr_id_value").alias("use_person"), asset_id.alias("asset_id"),
                    action.alias("action"), F.lit("3").alias("source"))


def sync_tables(actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """UPS-25: what a sync changes in the tables of assets, addresses and source records.  An address that the
    CMDB lists twice is one asset; its last name and person in order count."""
    rows = actions.where("action <> 'skipped'").groupBy("cmdb_ip").agg(F.max(F.struct("asset_name", "use_person", "asset_id", "action")).alias("r")).select("cmdb_ip", "r.*")
    blank = {c: F.lit(v) for c, v in (("node_id", "1"), ("type_id", "1"), ("asset_level", "3"), ("asset_label", ""), ("source", "3"), ("create_person", "cmdb"),
                                      ("register_state", "0"), ("delete_state", "1"), ("fall_state", "0"))}
    assets = rows.select("asset_id", "asset_name", "use_person", *(c.alias(n) for n, c in blank.items()))
    new = rows.where("action = 'inserted'")
    addresses = new.select("asset_id", F.col("cmdb_ip").alias("ip_addr"), F.lit("").alias("mac_addr"), F.lit("1").alias("group_id"))
    records = new.select(F.col("asset_id").alias("map_asset_id"), F.lit("3").alias("asset_source"), F.col("asset_id").alias("first_asset_id"))
    return assets, addresses, records


def sync_counters(actions: DataFrame) -> DataFrame:
    """AGG-21: with ip, without ip, inserted, updated."""
    return actions.agg(F.count_if(F.col("action") != "skipped").alias("with_ip"),
                       F.count_if(F.col("action") == "skipped").alias("without_ip"),
                       F.count_if(F.col("action") == "inserted").alias("inserted"),
                       F.count_if(F.col("action") == "updated").alias("updated"))


def label_ids(assets: DataFrame, label_col: str, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UPS-23: split the comma-separated labels, register unknown ones with new ids, and
    give each asset its label ids re-joined with ',' in label order.  Returns
    (new dictionary rows, per-asset ids)."""
    ex = assets.select("asset_id", F.posexplode(F.split(F.col(label_col), ",")).alias("pos", "label_name")) \
        .filter(F.col("label_name") != "")
    new = assign_new_ids(ex.select("label_name"), dictionary, "label_name", "label_id")
    full = dictionary.select("label_name", F.col("label_id").cast("long").alias("label_id")).unionByName(new)
    j = ex.join(full, "label_name", "left")
    per = j.groupBy("asset_id").agg(F.array_sort(F.collect_list(F.struct("pos", "label_id"))).alias("l"))
    return new, per.select("asset_id", F.array_join(F.transform("l", lambda x: x["label_id"].cast("string")), ",")
                           .alias("label_ids"))
