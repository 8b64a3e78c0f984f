"""Asset enrichment, discovery and organisation attribution.

Covers JOIN-01/03/04/05/06/07/08/18/19/20/21/22, AGG-17/18/19/23, WIN-02, SET-02, UPS-22,
FLT-16/30, SCL-03/04/14/15.

The reference runs these as per-record SQL point lookups; here every lookup is a set join.
Dimension sides are left to the planner: a side whose measured size is under
``autoBroadcastJoinThreshold`` is broadcast, anything bigger is a sort-merge join.  AQE splits a
hot address there only when both sides are plain exchanges: ``ip_to_asset`` therefore hands out its key
as a new expression, so that a join doesn't reuse the partitioning of its aggregate.
Per-asset aggregates are all keyed by ``asset_id`` so their joins reuse one hash
partitioning instead of re-shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import net as N
from ..functions import text as T
from ..functions.plan import sieved


# --- JOIN-05 / WIN-02 --------------------------------------------------------------------

def ip_to_asset(asset_ips: DataFrame, assets: DataFrame | None = None,
                active_only: bool = True) -> DataFrame:
    """One asset per address: the registered asset (``delete_state = '1'``) with the smallest
    id -- a deterministic stand-in for "whatever row came back first" (Q11).

    One row for each address of the inventory, so it's never broadcast: the size that the optimizer reads from a
    file of consecutive numbers is a fraction of what the driver would hold, hence the hints."""
    ips = asset_ips.select("asset_id", "ip_addr")
    if assets is not None and active_only:
        ips = ips.join(assets.filter(F.col("delete_state") == "1").select("asset_id").hint("merge"),
                       "asset_id", "left_semi")
    one = ips.groupBy("ip_addr").agg(F.min("asset_id").alias("asset_id"))
    # a key of its own: the join exchanges this small side again, and can then split the other one
    return one.select(F.concat("ip_addr", F.lit("")).alias("ip_addr"), "asset_id").hint("merge")


#: Leading bits of an address that choose the partition of the address table.
NET_BITS = 16


def write_address_table(asset_ips: DataFrame, path: str) -> None:
    """The address table laid out for ``lookup_for``: a partition for each network of 2^16 addresses; addresses that are
    none are in the partition -1."""
    net = F.coalesce(F.shiftright(N.ip_to_long(F.col("ip_addr")), 32 - NET_BITS), F.lit(-1)).cast("int")
    asset_ips.select("asset_id", "ip_addr", net.alias("net")).repartition("net").write.mode("overwrite").partitionBy("net").parquet(path)


def lookup_for(records: DataFrame, ip_cols: list[str], path: str, assets: DataFrame | None = None) -> DataFrame:
    """JOIN-03: ``ip_to_asset`` of the addresses that a batch names, reading only their networks of the table at ``path``.

    The batch's distinct networks come to the driver: at most 2^16 small numbers, whatever the batch.  They are
    a filter on the table's partitions, so the scan opens no other file.  In them, the batch's
    addresses are a semi join."""
    wanted = records.select(F.explode(F.array(*[F.col(c) for c in ip_cols])).alias("ip_addr")).where("ip_addr IS NOT NULL").distinct()
    nets = wanted.select(F.coalesce(F.shiftright(N.ip_to_long(F.col("ip_addr")), 32 - NET_BITS), F.lit(-1)).cast("int").alias("net")).distinct()
    named = sorted(r.net for r in nets.collect())
    table = records.sparkSession.read.schema("asset_id string, ip_addr string, net int").parquet(path)
    near = table.where(F.col("net").isin(named)).select("asset_id", "ip_addr").join(wanted, "ip_addr", "left_semi")
    return ip_to_asset(near, assets)


# --- AGG-17 / AGG-18 / AGG-23 / JOIN-22 --------------------------------------------------

def software_per_asset(installed: DataFrame) -> DataFrame:
    """Installed (``install_state = '1'``) software names per asset: sorted, comma joined.
    De-duplicated first, so a group is bounded by the distinct names of one asset."""
    d = (installed.filter(F.col("install_state") == "1")
         .select("asset_id", "software_name").distinct())
    return d.groupBy("asset_id").agg(
        F.array_join(F.array_sort(F.collect_list("software_name")), ",").alias("software_list"),
        F.count(F.lit(1)).alias("n_software"))


def ip_mac_pairs(asset_ips: DataFrame) -> DataFrame:
    """All (ip, mac) of an asset, sorted, as ``ip/mac,ip/mac`` (AGG-23)."""
    return asset_ips.groupBy("asset_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("/", "ip_addr", "mac_addr"))), ",")
        .alias("ip_mac_list"))


def asset_details(assets: DataFrame, asset_ips: DataFrame, nodes: DataFrame, asset_types: DataFrame,
                  groups: DataFrame, installed: DataFrame, addresses: DataFrame | None = None) -> DataFrame:
    """One row per active address with its asset and all that the event's asset block says of it
    (DOM-25), as the struct ``detail``: every list is bounded by what one asset has.

    With ``addresses`` (``ip_addr``), other addresses may be left out: assets that none of them belongs to
    are dropped before anything of theirs is shuffled."""
    named = asset_ips
    if addresses is not None:
        named = sieved(asset_ips, F.xxhash64("ip_addr"), addresses, F.xxhash64("ip_addr"))
        assets, asset_ips, installed = (sieved(x, F.xxhash64("asset_id"), named, F.xxhash64("asset_id")) for x in (assets, asset_ips, installed))
    ips = asset_ips.select("asset_id", "ip_addr", "mac_addr", "group_id").join(groups, "group_id", "left")
    per = ips.groupBy("asset_id").agg(
        F.array_sort(F.collect_set(F.struct(F.col("ip_addr").alias("ip"), F.coalesce("mac_addr", F.lit("")).alias("mac")))).alias("ip_group"),
        F.min("group_name").alias("network"))
    soft = (installed.filter(F.col("install_state") == "1")
            .groupBy("asset_id").agg(F.array_sort(F.collect_set("software_name")).alias("applications")))
    a = (assets.join(nodes.select("node_id", F.col("node_name").alias("unit")), "node_id", "left")
         .join(asset_types, "type_id", "left").join(per, "asset_id", "left").join(soft, "asset_id", "left"))
    user = F.col("create_person") if "create_person" in assets.columns else F.lit(None).cast("string")
    detail = a.select("asset_id", "os_ver", "unit", F.struct(
        "ip_group", "network", F.col("type_name").alias("type"), "asset_level", user.alias("user"), F.col("use_person").alias("manager"),
        "applications").alias("detail"))
    return ip_to_asset(named, assets).join(detail, "asset_id", "left")


# --- JOIN-01 / JOIN-04 / JOIN-21 ---------------------------------------------------------

def asset_profile(assets: DataFrame, asset_ips: DataFrame, nodes: DataFrame,
                  node_types: DataFrame, asset_types: DataFrame, groups: DataFrame,
                  installed: DataFrame) -> DataFrame:
    """Address -> asset profile: asset, node and its type, asset type, group, every
    ip/mac pair and the installed software list (the 7-way outer join, pre-aggregated
    once instead of six lookups per event)."""
    a = assets.select("asset_id", "asset_name", "os_ver", "node_id", "type_id", "use_person",
                      "asset_level")
    prof = (asset_ips.select("asset_id", "ip_addr", "group_id")
            .join(a, "asset_id")
            .join(nodes.select("node_id", "node_name", "node_type_id"), "node_id", "left")
            .join(node_types, "node_type_id", "left")
            .join(asset_types, "type_id", "left")
            .join(groups, "group_id", "left")
            .join(software_per_asset(installed), "asset_id", "left")
            .join(ip_mac_pairs(asset_ips), "asset_id", "left"))
    return prof.select(
        "ip_addr", "asset_id", "asset_name", "os_ver",
        T.os_group(F.col("os_ver")).alias("os_group"),
        "node_name", "node_type_name", "type_name", "group_name", "use_person",
        F.coalesce("software_list", F.lit("")).alias("software_list"),
        F.coalesce("n_software", F.lit(0)).cast("long").alias("n_software"),
        "ip_mac_list")


def enrich_sides(records: DataFrame, lookup: DataFrame, sides: dict[str, str],
                 fields: list[str]) -> DataFrame:
    """Left-join ``lookup`` (one row per ``ip_addr``) once per side column (JOIN-04:
    source and destination), prefixing the looked-up fields with the side name."""
    out = records
    for side, col in sides.items():
        lk = lookup.select(F.col("ip_addr").alias(f"_{side}_ip"),
                           *[F.col(f).alias(f"{side}_{f}") for f in fields])
        out = out.join(lk, out[col] == lk[f"_{side}_ip"], "left").drop(f"_{side}_ip")
    return out


# --- JOIN-06 / FLT-16 --------------------------------------------------------------------

def unknown_internal_addresses(records: DataFrame, ip_cols: list[str], known_ips: DataFrame,
                               reporter_col: str | None = None) -> DataFrame:
    """Private addresses seen in ``records`` that no asset owns yet (anti join).  One row
    per address with the smallest reporter as ``create_person``."""
    arr = F.array(*[F.col(c) for c in ip_cols])
    sel = [F.explode(arr).alias("ip_addr")]
    if reporter_col:
        sel.append(F.col(reporter_col).alias("reporter"))
    ex = records.select(*sel).filter(N.is_private(F.col("ip_addr")))
    agg = [F.min("reporter").alias("create_person")] if reporter_col else []
    cand = ex.groupBy("ip_addr").agg(*agg) if agg else ex.select("ip_addr").distinct()
    return cand.join(known_ips.select("ip_addr").distinct(), "ip_addr", "left_anti")


# --- JOIN-07 / SET-02 / SCL-04 ------------------------------------------------------------

def network_ranges(node_networks: DataFrame) -> DataFrame:
    """Node network rows -> inclusive [lo, hi] LONG ranges: type 1 start-end, type 2
    ip+mask, type 3 a single address."""
    lo2, hi2 = N.mask_bounds(F.col("ip"), F.col("mask"))
    v = N.ip_to_long(F.col("ip"))
    lo = (F.when(F.col("networktype") == "1", v).when(F.col("networktype") == "2", lo2)
           .when(F.col("networktype") == "3", v))
    hi = (F.when(F.col("networktype") == "1", N.ip_to_long(F.col("end_ip")))
           .when(F.col("networktype") == "2", hi2).when(F.col("networktype") == "3", v))
    return node_networks.select("node_id", "data_type", lo.alias("lo"), hi.alias("hi")) \
        .filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())


def attribute_org(addresses: DataFrame, node_networks: DataFrame,
                  ip_col: str = "ip_addr") -> DataFrame:
    """Organisation node of each address: nodes whose include ranges contain it, minus nodes
    whose exclude ranges contain it; exactly one node left -> that node, else the default
    node.  Ranges become their exact cover of aligned blocks (at most 64 for any range), an
    address probes the 33 blocks that hold it, and the join on (size, block) has true hits only:
    no broadcast, no nested loop, and no address meets a range that doesn't contain it."""
    r = network_ranges(node_networks)
    rb = r.select("node_id", "data_type", F.explode(N.cidr_cover(F.col("lo"), F.col("hi"))).alias("b")) \
        .select("node_id", "data_type", "b.bits", "b.block")
    a = addresses.select(F.col(ip_col).alias("_ip")).distinct().withColumn("_v", N.ip_to_long(F.col("_ip"))) \
        .filter(F.col("_v").isNotNull()).select("_ip", F.explode(N.cidr_probes(F.col("_v"))).alias("b")).select("_ip", "b.bits", "b.block")
    hits = a.join(rb, ["bits", "block"])
    sets = hits.groupBy("_ip").agg(
        F.collect_set(F.when(F.col("data_type") == "0", F.col("node_id"))).alias("inc"),
        F.collect_set(F.when(F.col("data_type") != "0", F.col("node_id"))).alias("exc"))
    org = sets.select("_ip", F.array_except("inc", "exc").alias("nodes"))
    org = org.select("_ip", F.when(F.size("nodes") == 1, F.col("nodes")[0])
                     .otherwise(F.lit(C.DEFAULT_NODE_ID)).alias("org_node_id"))
    out = addresses.join(org, addresses[ip_col] == org["_ip"], "left").drop("_ip")
    return out.withColumn("org_node_id", F.coalesce("org_node_id", F.lit(C.DEFAULT_NODE_ID)))


# --- JOIN-08 -----------------------------------------------------------------------------

def device_node(records: DataFrame, devices: DataFrame, device_col: str) -> DataFrame:
    """Reporting device -> its node id, default node when unknown."""
    d = devices.select(F.col("device_id").alias("_dev"), F.col("node_id").alias("device_node_id")) \
        .groupBy("_dev").agg(F.min("device_node_id").alias("device_node_id")) \
        .select(F.concat("_dev", F.lit("")).alias("_dev"), "device_node_id")  # a key of its own, as in ip_to_asset
    out = records.join(d, records[device_col] == d["_dev"], "left").drop("_dev")
    return out.withColumn("device_node_id", F.coalesce("device_node_id", F.lit(C.DEFAULT_NODE_ID)))


# --- UPS-22 / FLT-30 / SCL-15 ------------------------------------------------------------

def register_discovered(candidates: DataFrame, node_networks: DataFrame, source: str,
                        id_prefix: str) -> DataFrame:
    """Registration rows for newly discovered addresses with the per-source defaults; the
    id is ``upper(md5(prefix || ip))`` (deterministic, Q1)."""
    withorg = attribute_org(candidates, node_networks)
    return withorg.select(
        F.upper(F.md5(F.concat(F.lit(id_prefix), F.col("ip_addr")))).alias("asset_id"),
        "ip_addr",
        F.col("org_node_id").alias("node_id"),
        F.lit("1").alias("type_id"),
        F.lit("3").alias("asset_level"),
        F.lit(source).alias("source"),
        F.coalesce(F.col("create_person"), F.lit("")).alias("create_person")
        if "create_person" in candidates.columns else F.lit("").alias("create_person"),
        F.lit("1").alias("group_id"),
        F.lit("1").alias("delete_state"),
    )


def well_formed() -> F.Column:
    """FLT-20 for a row to register: an IPv4 address, and a dashed MAC if it has one."""
    mac = F.coalesce("mac_addr", F.lit(""))
    return N.is_valid_ipv4(F.col("ip_addr")) & ((mac == "") | N.is_dash_mac(mac))


def malformed(candidates: DataFrame) -> DataFrame:
    """Rows that can't be registered, with the reason."""
    reason = F.when(~N.is_valid_ipv4(F.col("ip_addr")), "address").otherwise("mac")
    return candidates.where(~well_formed()).withColumn("reason", reason)


def discovered(candidates: DataFrame, asset_ips: DataFrame, assets: DataFrame, node_networks: DataFrame) -> DataFrame:
    """Asset and address columns of addresses that no active asset has, reported by any source (UPS-22, FLT-30).

    ``candidates``: ip_addr, mac_addr, source, reporter, own_id (the source's own id of the asset, or null).  One
    asset for each address, of the source with the smallest number and, in it, the smallest reporter; its id
    is that of the source or a digest of source and address (Q1).  Malformed rows register nothing and go to the quarantine
    (``malformed``)."""
    known = ip_to_asset(asset_ips, assets).select("ip_addr")
    one = candidates.where(well_formed()).groupBy("ip_addr").agg(
        F.min(F.struct("source", F.coalesce("reporter", F.lit("")).alias("reporter"), F.coalesce("own_id", F.lit("")).alias("own_id"),
                       F.coalesce("mac_addr", F.lit("")).alias("mac_addr"))).alias("c"))
    one = one.join(known, "ip_addr", "left_anti").select("ip_addr", "c.*")
    one = attribute_org(one, node_networks)
    asset_id = F.when(F.col("own_id") != "", F.col("own_id")).otherwise(F.upper(F.md5(F.concat("source", F.lit(":"), "ip_addr"))))
    group = F.when(N.is_private(F.col("ip_addr")), "1").otherwise("2")
    return one.select(
        asset_id.alias("asset_id"), F.col("org_node_id").alias("node_id"), F.lit("1").alias("type_id"), F.lit("3").alias("asset_level"), F.lit("").alias("asset_name"),
        F.lit("").alias("asset_label"), "source", F.col("reporter").alias("create_person"), F.lit("").alias("use_person"), F.lit("0").alias("register_state"),
        F.lit("1").alias("delete_state"), F.lit("0").alias("fall_state"), "ip_addr", "mac_addr", group.alias("group_id"))


def discovered_tables(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that ``discovered`` adds to the tables of assets and of addresses."""
    return found.drop("ip_addr", "mac_addr", "group_id"), found.select("asset_id", "ip_addr", "mac_addr", "group_id")


# --- JOIN-18 / JOIN-19 / JOIN-20 (CMDB extracts, SNK-12) -----------------------------------

def cmdb_asset_extract(assets: DataFrame, asset_types: DataFrame, nodes: DataFrame) -> DataFrame:
    n = nodes.filter(F.col("state") == "1").select("node_id", "node_name")
    return (assets.join(asset_types, "type_id", "left").join(n, "node_id", "left")
            .select("asset_id", "asset_name", "os_ver", "type_name", "node_name", "delete_state"))


def cmdb_software_extract(library: DataFrame, software_types: DataFrame) -> DataFrame:
    return library.join(software_types, "software_type_id", "left").select(
        "software_id", "software_name", "publisher", "software_type_name")


def cmdb_hardware_extract(hardware: DataFrame, hardware_types: DataFrame) -> DataFrame:
    ht = hardware_types.filter(F.col("state") == "1").select("hardware_type_id", "hardware_type_name")
    return hardware.join(ht, "hardware_type_id", "left").select(
        "asset_id", "hardware_type_id", "hardware_type_name", "brand", "manufacturer",
        F.when(F.col("serial_number") == "None", F.lit(None)).otherwise(F.col("serial_number"))
        .alias("serial_number"),
        T.bytes_to_g(F.col("capacity")).alias("capacity"))



# --- JOIN-02 -----------------------------------------------------------------------------

def asset_by_source_id(records: DataFrame, source_records: DataFrame, id_col: str) -> DataFrame:
    """Superseded variant of the endpoint enrichment: the asset found through the
    source-record map (external agent id -> first asset id) instead of the address."""
    m = source_records.groupBy(F.col("map_asset_id").alias("_mid")).agg(F.min("first_asset_id").alias("mapped_asset_id"))
    m = m.select(F.concat("_mid", F.lit("")).alias("_mid"), "mapped_asset_id")  # a key of its own, as in ip_to_asset
    return records.join(m, records[id_col] == m["_mid"], "left").drop("_mid")
