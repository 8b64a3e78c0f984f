"""Side feeds: sandbox reports, SNMP traps, SNMP walks, drop-folder XML + captures, API
payloads, topic snapshots.

Covers SRC-06/07/11/12/13/14/20, FLT-25/26/27/28, DOM-30..33, JOIN-16/17, SCL-22/23.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T

# FIXED VALUES -- the sandbox report prefix and its field positions (md5, trust, finished).
SANDBOX_PREFIX = "PTA-REPORT:"
SANDBOX_MD5, SANDBOX_TRUST, SANDBOX_FINISHED = 2, 7, 10
# FIXED VALUES -- SNMP table OIDs and column numbers used by the inventory.
IF_TABLE, IP_TABLE, STORAGE_TABLE = "1.3.6.1.2.1.2.2.1", "1.3.6.1.2.1.4.20.1", "1.3.6.1.2.1.25.2.3.1"
CPU_TABLE, SYSTEM_TABLE = "1.3.6.1.2.1.25.3.3.1", "1.3.6.1.2.1.1"
IF_COLUMNS = {"1": "if_index", "2": "name", "3": "type", "4": "mtu", "5": "speed", "6": "mac"}
IP_COLUMNS = {"1": "ip", "2": "if_index", "3": "mask"}
STORAGE_COLUMNS = {"1": "index", "2": "type_oid", "3": "descr", "4": "units", "5": "size", "6": "used"}
TRAP_OID_NAMES = ["SNMPv2-MIB::snmpTrapOID.0", C.SNMP_TRAP_OID]


# --- SRC-07 ------------------------------------------------------------------------------

def sandbox_reports(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Strip the prefix, split on '|': md5 (field 2), trust (field 7, '1' = black), finished
    (field 10)."""
    parts = F.split(F.replace(F.col(value_col), F.lit(SANDBOX_PREFIX), F.lit("")), r"\|")
    return lines.select("*", F.get(parts, SANDBOX_MD5).alias("md5"), F.get(parts, SANDBOX_TRUST).alias("trust"),
                        F.get(parts, SANDBOX_FINISHED).alias("finished")) \
        .withColumn("verdict", F.when(F.col("trust") == "1", "black").otherwise("white"))


# --- SRC-13 / FLT-26 / FLT-27 / FLT-28 ------------------------------------------------------

def trap_records(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """``{"message": text}`` traps -> host, transport, varbind map (``OID value`` lines from
    the third line on) and the ``oid = val, ...`` rendering."""
    txt = F.from_json(F.col(value_col), "message STRING")["message"]
    lines = F.split(txt, "\n")
    vb = F.filter(lines, lambda x, i: (i >= 2) & (x != ""))
    entries = F.transform(vb, lambda x: F.struct(F.split(x, " ", 2).getItem(0).alias("oid"),
                                                 F.coalesce(F.split(x, " ", 2).getItem(1), F.lit("")).alias("val")))
    return messages.select(
        "*", F.get(lines, 0).alias("host"), F.get(lines, 1).alias("transport"),
        F.map_from_entries(entries).alias("varbinds"),
        F.array_join(F.transform(entries, lambda e: F.concat_ws(" = ", e["oid"], e["val"])), ", ").alias("rendered"))


def trap_type(varbinds: Column) -> Column:
    """FLT-27: value of the trap-OID varbind (textual or numeric OID name)."""
    return F.coalesce(*[F.try_element_at(varbinds, F.lit(n)) for n in TRAP_OID_NAMES])


def link_state(varbinds: Column, watched: str) -> Column:
    """FLT-26: when some value equals the watched name and another value is 'up' / 'down',
    the link state; else NULL."""
    vals = F.map_values(varbinds)
    state = F.when(F.array_contains(vals, "down"), "down").when(F.array_contains(vals, "up"), "up")
    return F.when(F.array_contains(vals, watched), state)


def v1_trap_line(enterprise: Column, agent: Column, generic: Column, specific: Column, uptime: Column) -> Column:
    """FLT-28: one-line rendering of an SNMPv1 trap."""
    return F.format_string("enterprise=%s agent=%s generic=%s specific=%s uptime=%s",
                           enterprise, agent, generic, specific, uptime)


# --- SRC-14 / DOM-30..33 / JOIN-16 / SCL-22 / SCL-23 ---------------------------------------

def _pivot(walks: DataFrame, table_oid: str, columns: dict[str, str]) -> DataFrame:
    t = walks.filter(F.col("table_oid") == table_oid)
    p = t.groupBy("host", "idx").pivot("column", list(columns)).agg(F.first("value"))
    return p.select("host", "idx", *[F.col(c).alias(n) for c, n in columns.items()])


def interface_inventory(walks: DataFrame) -> DataFrame:
    """DOM-30 / JOIN-16: interface rows left-joined with the address rows on ifIndex."""
    ifs = _pivot(walks, IF_TABLE, IF_COLUMNS)
    ips = _pivot(walks, IP_TABLE, IP_COLUMNS).drop("idx")
    return ifs.join(ips, ["host", "if_index"], "left").select(
        "host", "if_index", "name", "type", "mtu", "speed", "mac", "ip", "mask")


def storage_type_name(oid: Column) -> Column:
    """SCL-22: hrStorage type OID -> name, unknown -> the 'other' name."""
    m = F.create_map(*[F.lit(x) for kv in C.STORAGE_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, oid), F.lit(C.STORAGE_TYPE_OTHER))


def storage_inventory(walks: DataFrame) -> DataFrame:
    """DOM-31: storage rows: type name, description (hex decoded), bytes = units x size,
    used bytes and utilisation."""
    s = _pivot(walks, STORAGE_TABLE, STORAGE_COLUMNS)
    units, size, used = (F.col(c).cast("long") for c in ("units", "size", "used"))
    return s.select("host", F.col("index").alias("storage_index"), storage_type_name(F.col("type_oid")).alias("type"),
                    T.hex_to_text(F.col("descr")).alias("descr"), (units * size).alias("size_bytes"),
                    (units * used).alias("used_bytes"),
                    F.round(F.when(size > 0, used / size), 4).alias("utilisation"))


def cpu_load(walks: DataFrame) -> DataFrame:
    """DOM-32: per host the per-core loads (ordered by core) and their average."""
    c = walks.filter((F.col("table_oid") == CPU_TABLE) & (F.col("column") == "2"))
    return c.groupBy("host").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("i"),
                                                                      F.col("value").alias("v")))),
                                 lambda x: x["v"]), ",").alias("loads"),
        F.round(F.avg(F.col("value").cast("double")), 4).alias("avg_load"),
        F.count(F.lit(1)).alias("cores"))


def system_info(walks: DataFrame) -> DataFrame:
    """DOM-33: system description, name and OS family ('windows' when the description
    mentions it)."""
    s = walks.filter(F.col("table_oid") == SYSTEM_TABLE).groupBy("host").pivot("column", ["1", "5"]) \
        .agg(F.first("value"))
    return s.select("host", F.col("1").alias("descr"), F.col("5").alias("sys_name"),
                    F.when(F.col("1").contains("indows"), "windows").otherwise("other").alias("os_family"))


# --- SRC-10/11/12 / FLT-25 / JOIN-17 --------------------------------------------------------

XML_FIELDS = ["FILENAME", "LINENO", "TASKID", "GROUPID", "DANWEI", "RULEID", "TASKTIME"]


def file_kind(path: Column) -> Column:
    """FLT-25: route by suffix."""
    return F.when(path.endswith(".xml"), "xml").when(path.endswith(".pcap"), "pcap")


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def xml_metadata(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """SRC-11: text of the first element of each metadata field."""
    x = files.filter(file_kind(F.col(path_col)) == "xml")
    return x.select(stem(F.col(path_col)).alias("stem"),
                    *[F.xpath_string(F.col(content_col), F.lit(f"//{f}[1]")).alias(f.lower()) for f in XML_FIELDS])


def capture_listing(files: DataFrame, path_col: str = "path") -> DataFrame:
    """SRC-12: capture files (path, stem); content is never read."""
    p = files.filter(file_kind(F.col(path_col)) == "pcap")
    return p.select(F.col(path_col).alias("pcap_path"), stem(F.col(path_col)).alias("stem"))


def pair_files(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """JOIN-17: metadata joined with its capture by stem (emitted once both halves exist)."""
    return xml_metadata(files, path_col, content_col).join(capture_listing(files, path_col), "stem")


# --- SRC-06 / SRC-20 ------------------------------------------------------------------------

def api_messages(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """SRC-06: ``{"data": [line...]}`` -> one ``{"message": line}`` record per line."""
    lines = F.from_json(F.col(body_col), "data ARRAY<STRING>")["data"]
    ex = payloads.select("*", F.posexplode(lines).alias("line_no", "line"))
    return ex.withColumn("value", F.to_json(F.struct(F.col("line").alias("message"))))


def topic_snapshot(topic: DataFrame, ts_col: str, value_col: str) -> DataFrame:
    """SRC-20: ``ts<TAB>message`` lines plus one ``total<TAB>n`` trailer."""
    lines = topic.select(F.concat_ws("\t", F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss"), F.col(value_col)).alias("line"))
    total = topic.agg(F.concat(F.lit("total\t"), F.count(F.lit(1)).cast("string")).alias("line"))
    return lines.unionByName(total)
