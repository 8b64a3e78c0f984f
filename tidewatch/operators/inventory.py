"""Inventory maintenance from the eight inventory topics (SRC-04, UPS-01..21, FLT-19..24,
SNK-09/10, JOIN-05/24/26, SET-03, WIN-01/04, SCL-20/21).

Each topic is decoded with its own declared schema; every maintained table is
"latest change per business key" (one shuffle on the key) followed by a full outer join
with the current snapshot (``operators.upsert``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import net as N
from ..functions import text as T
from ..functions.plan import bind
from . import upsert as U

CLIENT = "STRUCT<uuid: STRING, ip: STRING, server_uid: STRING, server_ip: STRING>"
TOPIC_SCHEMAS: dict[str, str] = {
    "ACD_client_info": ("server_ip STRING, server_uid STRING, uuid STRING, group_id STRING, sysver STRING, "
                        "status STRING, address ARRAY<STRUCT<ip: STRING, mac: STRING>>"),
    "ACD_software_info": (f"client {CLIENT}, softwareinfo ARRAY<STRUCT<path: STRING, ver: STRING, name: STRING, "
                          "instime: STRING, author: STRING>>"),
    "ACD_hardware_info": f"client {CLIENT}, data ARRAY<STRING>",
    "ACD_host_ports": (f"client {CLIENT}, portinfos ARRAY<STRUCT<sip: STRING, dip: STRING, proto: STRING, "
                       "proc: STRING, sport: INT, dport: INT>>"),
    "ACD_host_service": (f"client {CLIENT}, serviceinfo ARRAY<STRUCT<status: STRING, service: STRING, "
                         "name: STRING, path: STRING, class: STRING, systime: STRING>>"),
    "ACD_host_proc": (f"client {CLIENT}, porcinfos ARRAY<STRUCT<status: STRING, pid: STRING, proc: STRING, "
                      "systime: STRING>>"),
    "ACD_loophole_detect": f"client {CLIENT}, vuln_id STRING",
    "ACD_organization": ("server_ip STRING, server_uid STRING, org ARRAY<STRUCT<pid: STRING, id: STRING, "
                         "cname: STRING, group: ARRAY<STRUCT<pid: STRING, gid: STRING, gname: STRING>>>>"),
}
# FIXED VALUES: slot number -> document of the slot, with the keys that the agents send
HARDWARE_SLOTS: dict[int, str] = {
    0: "Name STRING, linenum STRING, NumberOfCores STRING, SocketDesignation STRING",
    1: "Manufacturer STRING, SerialNumber STRING, Version STRING, BIOSVersion STRING, BIOSReleaseDate STRING",
    3: "ARRAY<STRUCT<Caption: STRING, AdapterRAM: STRING, DriverVersion: STRING>>",
    4: "ARRAY<STRUCT<Manufacturer: STRING, PartNumber: STRING, SerialNumber: STRING, Speed: STRING, Capacity: STRING>>",
    5: "ARRAY<STRUCT<Manufacturer: STRING, Name: STRING, MACAddress: STRING, NetConnectionID: STRING, NetEnabled: STRING>>",
    6: "ARRAY<STRUCT<Caption: STRING, FirmwareRevision: STRING, Size: STRING>>",
    7: "ARRAY<STRUCT<Caption: STRING, MediaType: STRING, Drive: STRING>>",
    8: "ARRAY<STRUCT<Manufacturer: STRING, Caption: STRING>>",
}
HARDWARE_FIELDS = ("brand", "manufacturer", "serial_number", "version", "bios_version", "bios_time", "thread_num", "core_num",
                   "interface_type", "gcard_memory", "driver_version", "frequency", "capacity", "mac_addr", "net_card_type",
                   "is_connecte", "firmware_version", "cd_type", "drive_letter")
# hardware_type_id -> the columns that identify a component of an asset
HARDWARE_KEYS: dict[str, tuple[str, ...]] = {
    "1": ("brand",), "2": ("bios_version",), "3": ("manufacturer",), "4": ("brand",), "5": ("manufacturer",),
    "6": ("brand",), "7": ("brand",), "8": ("brand", "drive_letter"),
}


def decode(topic: DataFrame, name: str) -> DataFrame:
    """SRC-04: the rows of one inventory topic, decoded with that topic's schema."""
    t = topic.filter(F.col("topic") == name)
    m = bind(t, _m=F.from_json(F.col("value"), TOPIC_SCHEMAS[name]))
    return m.select("topic", "partition", "offset", "timestamp", "_m.*")


def resolve_asset(df: DataFrame, ips_col: str, uuid_col: str, ip_lookup: DataFrame) -> DataFrame:
    """JOIN-05: the asset owning the first reported address that is known, in list order,
    else the deterministic id ``upper(md5('iep' || uuid))`` of a new asset (Q1)."""
    key = ["topic", "partition", "offset"]
    ex = df.select(*key, F.posexplode(F.col(ips_col)).alias("_pos", "_ip"))
    hit = ex.join(ip_lookup.select(F.col("ip_addr").alias("_ip"), "asset_id"), "_ip") \
        .groupBy(*key).agg(F.min_by("asset_id", "_pos").alias("_found"))
    return _with_asset(df.join(hit, key, "left"), uuid_col)


def resolve_client(df: DataFrame, ip_lookup: DataFrame) -> DataFrame:
    """JOIN-05 for messages with the one address ``client.ip``: a plain lookup join, so the
    messages meet no aggregate and a hot address can be split."""
    hit = ip_lookup.select(F.col("ip_addr").alias("_ip"), F.col("asset_id").alias("_found"))
    return _with_asset(df.join(hit, F.col("client.ip") == F.col("_ip"), "left").drop("_ip"), "client.uuid")


def allowed(messages: DataFrame, allow: tuple[str, ...]) -> DataFrame:
    """FLT-12: messages of the allow-listed endpoint servers; ``-1`` = all."""
    return messages if "-1" in allow else messages.filter(F.col("client.server_ip").isin(*allow))


def orphans(resolved: DataFrame, reason: str = "unknown_address") -> DataFrame:
    """SNK-05: messages whose address belongs to no asset go back for another attempt: software,
    ports, services and processes are never attached to an invented asset."""
    return resolved.filter(~F.col("asset_known")).select(
        "topic", "partition", "offset", "timestamp", F.col("client.uuid").alias("uuid"), F.col("client.ip").alias("ip"),
        F.lit(reason).alias("reason"), F.lit(1).alias("attempts"))


def _with_asset(out: DataFrame, uuid_col: str) -> DataFrame:
    return (out.withColumn("asset_id", F.coalesce("_found", F.upper(F.md5(F.concat(F.lit("iep"), F.col(uuid_col))))))
               .withColumn("asset_known", F.col("_found").isNotNull()).drop("_found"))


# --- ACD_client_info: UPS-02/03/04/05, FLT-22/24, SNK-09, JOIN-24, WIN-04 -----------------

def client_changes(topic: DataFrame, ip_lookup: DataFrame) -> DataFrame:
    ci = decode(topic, "ACD_client_info")
    ci = ci.withColumn("_ips", F.transform(F.coalesce("address", F.array()), lambda a: a["ip"]))
    ci = resolve_asset(ci, "_ips", "uuid", ip_lookup).drop("_ips")
    install = F.col("status") == "install"
    return ci.select(
        "topic", "partition", "offset", "timestamp", "uuid", "asset_id", "asset_known", "address",
        F.col("sysver").alias("os_ver"),
        F.when(install, "1").otherwise("0").alias("delete_state"),
        F.when(install, F.col("server_uid")).alias("server_uid"),
        F.col("server_ip"),
        F.concat_ws("_", F.col("group_id"), F.col("server_ip")).alias("org_node_id"))


def latest_client_state(changes: DataFrame) -> DataFrame:
    return U.latest_per_key(changes, ["asset_id"], ["timestamp", "offset"])


def asset_snapshot(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """UPS-02: asset rows keyed by asset_id; OS, delete state, server uid updated."""
    latest = latest_client_state(changes).select("asset_id", "os_ver", "delete_state", "server_uid")
    snap = snapshot.select("asset_id", "os_ver", "delete_state", F.lit(None).cast("string").alias("server_uid"))
    return U.upsert(snap, latest, ["asset_id"], ["os_ver", "delete_state", "server_uid"])


def os_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """SNK-09: ``asset_status {uuid, type, old, new}`` for known assets whose OS changed."""
    latest = latest_client_state(changes).select("asset_id", "uuid", F.col("os_ver").alias("new"))
    return (snapshot.select("asset_id", F.col("os_ver").alias("old")).join(latest, "asset_id")
            .filter(~F.col("old").eqNullSafe(F.col("new")))
            .select("uuid", "asset_id", F.lit("os_ver").alias("type"), "old", "new"))


#: WIN-04: spans of time whose summaries are compared with each other inside the next longer one.
SPANS = ("minute", "day")


def os_transitions(changes: DataFrame) -> DataFrame:
    """WIN-04: successive reports of one agent whose OS differs from the previous report.

    A report is a run of length one: (first, last).  Runs are compared inside an agent's minute, the minutes'
    runs inside its day, the days' runs over all its time.  A change is found on the level at which its two
    reports first meet, and it names its report itself, so nothing is joined back.  A window holds the reports of an agent's
    minute, the minutes of a day or the days of its life: the clock bounds it, not the number of reports, and an
    agent with a third of all reports is spread over its minutes.  Equal times go by offset, then by OS."""
    report = F.struct("timestamp", "offset", "os_ver")
    runs = changes.select("uuid", report.alias("first"), report.alias("last"))
    levels = []
    for span in (*SPANS, None):
        within = ["uuid"] if span is None else ["uuid", "span"]
        if span is not None:
            runs = runs.withColumn("span", F.date_trunc(span, "first.timestamp"))
        before = F.lag("last.os_ver").over(Window.partitionBy(*within).orderBy("first"))
        levels.append(runs.select("uuid", F.col("first.offset").alias("offset"), before.alias("old"), F.col("first.os_ver").alias("new"))
                      .where(F.col("old") != F.col("new")))
        runs = runs.groupBy(*within).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return reduce(DataFrame.unionByName, levels)


def asset_ip_snapshot(snapshot_ips: DataFrame, changes: DataFrame) -> DataFrame:
    """UPS-03: (asset_id, ip) rows with the integer address value and normalised MAC."""
    ex = changes.select("asset_id", "timestamp", "offset", F.explode("address").alias("a"))
    rows = ex.select("asset_id", F.col("a.ip").alias("ip_addr"), N.ip_to_long(F.col("a.ip")).alias("ip_value"),
                     N.normalise_mac(F.col("a.mac")).alias("mac_addr"), "timestamp", "offset")
    latest = U.latest_per_key(rows, ["asset_id", "ip_addr"], ["timestamp", "offset"])
    snap = snapshot_ips.select("asset_id", "ip_addr", "ip_value", "mac_addr")
    return U.upsert(snap, latest.drop("timestamp", "offset"), ["asset_id", "ip_addr"], ["ip_value", "mac_addr"])


def source_record_changes(records: DataFrame, changes: DataFrame) -> DataFrame:
    """UPS-04 / JOIN-24: agent id -> asset id map; rows whose mapped asset changed or is new."""
    latest = U.latest_per_key(changes.select("uuid", "asset_id", "timestamp", "offset"), ["uuid"],
                              ["timestamp", "offset"])
    r = records.select(F.col("map_asset_id").alias("uuid"), F.col("first_asset_id").alias("old_asset_id"))
    j = latest.join(r, "uuid", "left")
    return (j.filter(~F.col("old_asset_id").eqNullSafe(F.col("asset_id")))
             .select("uuid", "old_asset_id", F.col("asset_id").alias("new_asset_id"),
                     F.when(F.col("old_asset_id").isNull(), "insert").otherwise("update").alias("_op")))


def server_registry(changes: DataFrame) -> DataFrame:
    """UPS-05: endpoint servers keyed by uid with their latest address and last report."""
    x = changes.filter(F.col("server_uid").isNotNull())
    last = F.max_by(F.struct("server_ip", "timestamp"), F.struct("timestamp", "offset", "server_ip"))
    return x.groupBy("server_uid").agg(last.alias("l"), F.count(F.lit(1)).alias("reports")).select(
        "server_uid", "l.server_ip", F.col("l.timestamp").alias("last_report"), "reports")


# --- ACD_software_info: UPS-06/07/08/09, FLT-19, JOIN-26, SET-03 --------------------------

def software_reports(topic: DataFrame, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """Messages of allowed endpoint servers with their asset; ``orphans`` has those of no asset."""
    return resolve_client(allowed(decode(topic, "ACD_software_info"), allow), ip_lookup)


def reported_software(reports: DataFrame, marked: bool = False) -> DataFrame:
    """FLT-19: the packages of all messages of known assets, without garbled ones.  With ``marked`` each message has
    one more row, without a package and with a true ``mark``."""
    packages = F.col("softwareinfo")
    if marked:
        none = F.array(F.lit(None).cast(reports.schema["softwareinfo"].dataType.elementType))
        packages = F.concat(F.coalesce(packages, F.slice(none, 1, 0)), none)
    ex = reports.filter("asset_known").select("asset_id", "timestamp", "offset", F.size(packages).alias("n"), F.posexplode(packages).alias("pos", "w"))
    mark = F.lit(False) if not marked else F.col("pos") == F.col("n") - 1
    garbled = (F.coalesce(F.col("w.name"), F.lit("")).contains("??") | F.coalesce(F.col("w.path"), F.lit("")).contains("??")
               | F.coalesce(F.col("w.ver"), F.lit("")).contains("??"))
    return ex.filter(~garbled).select("asset_id", F.col("w.name").alias("software_name"),
                                      F.col("w.ver").alias("version"), F.col("w.path").alias("install_addr"),
                                      F.col("w.instime").alias("install_time"), "timestamp", "offset", "pos", *([mark.alias("mark")] if marked else []))


def software_state(known: DataFrame, reports: DataFrame) -> DataFrame:
    """UPS-08/09: each message is the full list of its asset (JOIN-26, SET-03).  What the asset's
    last message lists has state '1' and what was known or reported before and is missing
    from it has state '0'; installs of assets that never reported keep state '1'.  The version is
    the one reported last, else the known one.

    Known and reported rows and a mark for each message are one union, reduced by a map-side combined
    aggregate per (asset, software); an asset's latest mark is its last message.  Both sides of the join are
    the same aggregate, so one shuffle serves them and each message is made and parsed once.  No full outer join is needed."""
    nul = lambda t: F.lit(None).cast(t)
    k = known.select("asset_id", "software_name", F.col("version").alias("k_version"),
                     F.struct("install_time", "version").alias("k_at"), nul("string").alias("r_version"),
                     nul("struct<timestamp:timestamp,offset:bigint,pos:int>").alias("r_at"), F.lit(False).alias("mark"))
    r = reported_software(reports, marked=True).select(
        "asset_id", "software_name", nul("string").alias("k_version"), nul(k.schema["k_at"].dataType.simpleString()).alias("k_at"),
        F.col("version").alias("r_version"), F.struct("timestamp", "offset", "pos").alias("r_at"), "mark")
    # the marks are told by an aggregate, which no filter is pushed through
    per = k.unionByName(r).groupBy("asset_id", "software_name", "mark").agg(
        F.max_by("k_version", "k_at").alias("k_version"), F.max_by("r_version", "r_at").alias("r_version"), F.max("r_at").alias("r_at"),
        F.max("mark").alias("marked"))
    # a mark has no version; naming both keeps the columns of the two sides alike
    last = per.where("marked").select(F.col("asset_id").alias("of"), F.struct("r_at.timestamp", "r_at.offset").alias("last"),
                                      F.coalesce("r_version", "k_version").alias("no_version"))
    j = per.where("not marked").join(last, F.col("asset_id").eqNullSafe(F.col("of")), "left")
    listed = F.struct("r_at.timestamp", "r_at.offset").eqNullSafe(F.col("last"))
    return j.select("asset_id", "software_name", F.coalesce("r_version", "k_version", "no_version").alias("version"),
                    F.when(F.col("last").isNull() | (F.col("r_at").isNotNull() & listed), "1").otherwise("0").alias("install_state"))


def software_library(library: DataFrame, reported: DataFrame) -> DataFrame:
    """UPS-06: library keyed by name; a re-reported package goes from state '0' to '1';
    unknown names are inserted with a deterministic id."""
    names = reported.select("software_name").distinct().withColumn("state", F.lit("1"))
    out = U.upsert(library.select("software_id", "software_name", "state"), names, ["software_name"], ["state"],
                   insert_defaults={})
    return out.withColumn("software_id", F.coalesce("software_id",
                                                    F.upper(F.md5(F.concat(F.lit("sw"), F.col("software_name"))))))


# --- ACD_hardware_info: UPS-10..17, FLT-21, SCL-20 ---------------------------------------

def _component(kind: str, **fields):
    """One component with all columns; those not given are NULL."""
    return F.struct(F.lit(kind).alias("hardware_type_id"),
                    *[fields.get(f, F.lit(None)).cast("string").alias(f) for f in HARDWARE_FIELDS])


def _none(c):
    """FLT-21: the word 'None' and empty text are NULL."""
    return F.nullif(F.nullif(c, F.lit("None")), F.lit(""))


def hardware_messages(topic: DataFrame, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """Messages of allowed endpoint servers (``-1`` = all) with their asset; ``orphans`` has
    those of no asset."""
    return resolve_client(allowed(decode(topic, "ACD_hardware_info"), allow), ip_lookup)


def hardware_rows(messages: DataFrame) -> DataFrame:
    """One row per component of known assets: the slots become one array, exploded once."""
    h = messages.filter("asset_known")
    h = bind(h, **{f"_s{i}": F.from_json(F.get(F.col("data"), i), schema) for i, schema in HARDWARE_SLOTS.items()})
    one = lambda i, c: F.when(F.col(f"_s{i}").isNotNull(), F.array(c)).otherwise(F.array())
    many = lambda i, f: F.transform(F.coalesce(F.col(f"_s{i}"), F.array()), f)
    cpu, board = F.col("_s0"), F.col("_s1")
    parts = F.concat(
        one(0, _component("1", brand=cpu["Name"], thread_num=cpu["linenum"], core_num=cpu["NumberOfCores"],
                          interface_type=cpu["SocketDesignation"])),
        # the serial number and version drop the word only, the date empty text too
        one(1, _component("2", manufacturer=board["Manufacturer"], serial_number=F.nullif(board["SerialNumber"], F.lit("None")),
                          version=F.nullif(board["Version"], F.lit("None")), bios_version=board["BIOSVersion"],
                          bios_time=_none(board["BIOSReleaseDate"]))),
        many(3, lambda x: _component("6", brand=x["Caption"], gcard_memory=x["AdapterRAM"], driver_version=x["DriverVersion"])),
        many(4, lambda x: _component("3", manufacturer=x["Manufacturer"], brand=x["PartNumber"], serial_number=x["SerialNumber"],
                                     frequency=x["Speed"], capacity=x["Capacity"])),
        many(5, lambda x: _component("5", manufacturer=x["Manufacturer"], brand=x["Name"], mac_addr=x["MACAddress"],
                                     net_card_type=x["NetConnectionID"],
                                     is_connecte=F.when(x["NetEnabled"] == "True", "1").otherwise("0"))),
        many(6, lambda x: _component("4", brand=x["Caption"], firmware_version=x["FirmwareRevision"], capacity=T.bytes_to_g(x["Size"]))),
        many(7, lambda x: _component("8", brand=x["Caption"], cd_type=x["MediaType"], drive_letter=x["Drive"])),
        many(8, lambda x: _component("7", brand=x["Caption"], manufacturer=x["Manufacturer"])))
    return h.select("asset_id", "timestamp", "offset", F.posexplode(parts).alias("pos", "x")).select(
        "asset_id", "timestamp", "offset", "pos", "x.*")


def _hardware_key():
    key = F.lit(None).cast("string")
    for kind, columns in HARDWARE_KEYS.items():
        key = F.when(F.col("hardware_type_id") == kind, F.concat_ws("|", *columns)).otherwise(key)
    return key


def hardware_state(snapshot: DataFrame, rows: DataFrame) -> DataFrame:
    """UPS-10..17: the detail table after all reports.  Per (asset, type, key) the last report (of
    equal times and offsets, the later component) sets the columns; a mainboard keeps the maker it was
    first registered with.  Snapshot and reports are one union, reduced by one map-side combined
    aggregate."""
    columns = ["asset_id", "hardware_type_id", *HARDWARE_FIELDS]
    s = snapshot
    for f in HARDWARE_FIELDS:
        if f not in s.columns:
            s = s.withColumn(f, F.lit(None).cast("string"))
    at = "struct<known:boolean,timestamp:timestamp,offset:bigint,pos:int>"
    s = s.select(*columns, F.struct(F.lit(False), F.lit(None).cast("timestamp"), F.lit(None).cast("bigint"),
                                    F.lit(None).cast("int")).cast(at).alias("at"))
    r = rows.select(*columns, F.struct(F.lit(True), "timestamp", "offset", "pos").cast(at).alias("at"))
    u = s.unionByName(r).withColumn("hw_key", _hardware_key())
    g = u.groupBy("asset_id", "hardware_type_id", "hw_key").agg(
        F.max_by(F.struct(*HARDWARE_FIELDS), "at").alias("last"), F.min_by("manufacturer", "at").alias("maker"),
        F.bool_or(F.col("at.known")).alias("reported"), F.bool_or(~F.col("at.known")).alias("known"))
    fields = [F.when(F.col("hardware_type_id") == "2", F.col("maker")).otherwise(F.col("last.manufacturer")).alias(f)
              if f == "manufacturer" else F.col(f"last.{f}").alias(f) for f in HARDWARE_FIELDS]
    op = F.when(F.col("known") & F.col("reported"), "update").when(F.col("reported"), "insert").otherwise("keep")
    return g.select("asset_id", "hardware_type_id", "hw_key", *fields, op.alias("_op"))


# --- ports / services / processes / vulnerabilities: UPS-18..21, SNK-10 -------------------

def host_messages(topic: DataFrame, name: str, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """One host topic's messages of allowed endpoint servers with their asset; ``orphans`` has those of no asset."""
    return resolve_client(allowed(decode(topic, name), allow), ip_lookup)


def host_rows(topic: DataFrame, name: str, list_col: str, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    d = host_messages(topic, name, ip_lookup, allow).filter("asset_known")
    return d.select("asset_id", "timestamp", "offset", F.explode(list_col).alias("x"))


def ports(topic: DataFrame, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """UPS-20: port rows; the -1 port sentinel becomes NULL (FLT-21)."""
    r = host_rows(topic, "ACD_host_ports", "portinfos", ip_lookup, allow)
    return r.select("asset_id", "offset", F.col("x.sip").alias("sip"), F.col("x.dip").alias("dip"),
                    F.col("x.proto").alias("proto"), F.col("x.proc").alias("proc"),
                    F.nullif(F.col("x.sport"), F.lit(-1)).alias("sport"),
                    F.nullif(F.col("x.dport"), F.lit(-1)).alias("dport"))


def services(topic: DataFrame, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """UPS-18: service rows with the executable path cleaned (SCL-21)."""
    r = host_rows(topic, "ACD_host_service", "serviceinfo", ip_lookup, allow)
    return r.select("asset_id", "offset", F.col("x.service").alias("service"), F.col("x.name").alias("name"),
                    T.service_path(F.col("x.path")).alias("path"), F.col("x.status").alias("status"),
                    F.col("x.systime").alias("systime"))


def processes(topic: DataFrame, ip_lookup: DataFrame, allow: tuple[str, ...] = ("-1",)) -> DataFrame:
    """UPS-19: process rows."""
    r = host_rows(topic, "ACD_host_proc", "porcinfos", ip_lookup, allow)
    return r.select("asset_id", "offset", F.col("x.pid").alias("pid"), F.col("x.proc").alias("proc"),
                    F.col("x.status").alias("status"), F.col("x.systime").alias("systime"))


def vulnerability_rewrite(topic: DataFrame, ip_lookup: DataFrame) -> DataFrame:
    """UPS-21 / SNK-10: the vulnerability message with ``client.uuid`` replaced by the
    resolved (or newly derived) asset id."""
    d = resolve_client(decode(topic, "ACD_loophole_detect"), ip_lookup)
    return d.select("offset", F.col("client.uuid").alias("agent_uuid"),
                    F.col("client").withField("uuid", F.col("asset_id")).alias("client"), "vuln_id", "asset_known")


# --- ACD_organization: UPS-01, FLT-24 ----------------------------------------------------

def org_node_changes(topic: DataFrame) -> DataFrame:
    """Company and department nodes as reported, ids suffixed with the reporting server's address;
    parent '0' means the root node '1'."""
    o = decode(topic, "ACD_organization")
    comp = o.select("server_ip", "timestamp", "offset", F.explode("org").alias("c"))
    sfx = lambda c: F.concat_ws("_", c, F.col("server_ip"))
    companies = comp.select(sfx(F.col("c.id")).alias("node_id"), F.col("c.cname").alias("node_name"),
                            F.when(F.col("c.pid") == "0", F.lit(C.DEFAULT_NODE_ID)).otherwise(sfx(F.col("c.pid")))
                            .alias("parent_node_id"), F.lit("1").alias("node_type_id"), "timestamp", "offset")
    deps = comp.select("server_ip", "timestamp", "offset", F.explode("c.group").alias("g")).select(
        sfx(F.col("g.gid")).alias("node_id"), F.col("g.gname").alias("node_name"),
        F.when(F.col("g.pid") == "0", F.lit(C.DEFAULT_NODE_ID)).otherwise(sfx(F.col("g.pid"))).alias("parent_node_id"),
        F.lit("2").alias("node_type_id"), "timestamp", "offset")
    return companies.unionByName(deps)


def org_nodes(topic: DataFrame) -> DataFrame:
    """The last report of each node."""
    return U.latest_per_key(org_node_changes(topic), ["node_id"], ["timestamp", "offset"]).drop("timestamp", "offset")


def attach_org(changes: DataFrame, nodes: DataFrame) -> DataFrame:
    """FLT-24: a reported org node that does not exist maps to the root node '1'."""
    n = nodes.select(F.col("node_id").alias("_nid"))
    j = changes.join(n, changes["org_node_id"] == n["_nid"], "left")
    return j.withColumn("node_id", F.when(F.col("_nid").isNotNull(), F.col("org_node_id"))
                        .otherwise(F.lit(C.DEFAULT_NODE_ID))).drop("_nid")
