"""CMDB sync, label dictionary, scalar-function and plain-syslog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import net as N
from ..functions import text as T
from ..operators import cmdb as CM
from ..operators.dictionary import assign_new_ids
from ..sources import dims as D
from ..sources.derive import table, user_ip
from . import oracle_ctes as O
from .registry import register


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    js = F.to_json(F.struct(k.cast("string").alias("id"),
                            F.when(k < 5, F.lit("-1")).otherwise(F.col("n_regionkey").cast("string")).alias("parent_id")))
    return n.select(js.alias("value")).select(F.from_json("value", CM.CATEGORY_SCHEMA).alias("c")).select("c.*")


@register("cmdb_category_roots", covers=("FLT-23", "SRC-18", "Q13"), oracle="""
SELECT CAST(n_nationkey AS VARCHAR) AS id, '-1' AS parent_id FROM nation WHERE n_nationkey < 5
""")
def cmdb_category_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CM.category_roots(_categories(spark, sf_dir))


def _cmdb_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    page = F.struct(F.array(F.struct(
        F.when(k % 11 == 0, F.lit("")).otherwise(user_ip(k)).alias("cmdb_ip"), F.col("c_name").alias("cmdb_name"),
        F.concat(F.lit("p"), (k % 9).cast("string")).alias("cmdb_zrr_id_value"))).alias("pageData"))
    return CM.pages(c.select(F.to_json(page).alias("value")))


SYNC_CTE = f"""
{O.ASSET_IPS},
cm AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('10.', c_custkey // 256, '.', c_custkey % 256, '.1') END
              AS cmdb_ip, c_name AS asset_name, concat('p', c_custkey % 9) AS use_person FROM customer),
known AS (SELECT ip_addr, min(asset_id) AS aid FROM asset_ips GROUP BY ip_addr),
act AS (SELECT cm.*, CASE WHEN cmdb_ip = '' THEN NULL ELSE coalesce(k.aid, upper(md5(concat('cmdb', cmdb_ip)))) END
               AS asset_id,
               CASE WHEN cmdb_ip = '' THEN 'skipped' WHEN k.aid IS NOT NULL THEN 'updated' ELSE 'inserted' END AS action
        FROM cm LEFT JOIN known k ON k.ip_addr = cm.cmdb_ip)
"""


@register("cmdb_sync_actions", covers=("UPS-25", "FLT-29", "SRC-18"), oracle=f"""
WITH {SYNC_CTE}
SELECT cmdb_ip, asset_name, use_person, asset_id, action, '3' AS source FROM act
""")
def cmdb_sync_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CM.sync(_cmdb_pages(spark, sf_dir), D.asset_ips(spark, sf_dir))


@register("cmdb_sync_counters", covers=("AGG-21",), oracle=f"""
WITH {SYNC_CTE}
SELECT CAST(sum(CASE WHEN action <> 'skipped' THEN 1 ELSE 0 END) AS BIGINT) AS with_ip,
       CAST(sum(CASE WHEN action = 'skipped' THEN 1 ELSE 0 END) AS BIGINT) AS without_ip,
       CAST(sum(CASE WHEN action = 'inserted' THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(sum(CASE WHEN action = 'updated' THEN 1 ELSE 0 END) AS BIGINT) AS updated
FROM act
""")
def cmdb_sync_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CM.sync_counters(CM.sync(_cmdb_pages(spark, sf_dir), D.asset_ips(spark, sf_dir)))
    return c.select(*[F.col(x).cast("long").alias(x) for x in c.columns])


@register("asset_labels", covers=("UPS-23", "AGG-22"), oracle=f"""
WITH {O.ASSETS},
lab AS (SELECT asset_id, lower(c.c_mktsegment) AS l1, concat('n', c.c_nationkey) AS l2
        FROM assets a JOIN customer c ON c.c_custkey = a.c_custkey),
dict AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT lower(c_mktsegment) AS name
         FROM customer)),
newn AS (SELECT DISTINCT l2 AS name FROM lab WHERE l2 NOT IN (SELECT name FROM dict)),
newid AS (SELECT name, (SELECT max(id) FROM dict) + row_number() OVER (ORDER BY name) AS id FROM newn),
alld AS (SELECT * FROM dict UNION ALL SELECT * FROM newid)
SELECT lab.asset_id, concat(d1.id, ',', d2.id) AS label_ids
FROM lab JOIN alld d1 ON d1.name = lab.l1 JOIN alld d2 ON d2.name = lab.l2
""")
def asset_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = D.assets(spark, sf_dir).join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment",
                                                                               "c_nationkey"), "c_custkey")
    a = a.select("asset_id", F.concat_ws(",", F.lower("c_mktsegment"),
                                         F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("asset_label"))
    segs = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("label_name")).distinct()
    empty = spark.createDataFrame([], "label_name string, label_id long")
    dictionary = assign_new_ids(segs, empty, "label_name", "label_id")
    _, per = CM.label_ids(a, "asset_label", dictionary)
    return per


def _scalar_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    s = lambda c: c.cast("string")
    return table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.concat_ws(".", s(p % 300), s(p % 256), s((p * 7) % 256), s(p % 10)).alias("ip"),
        F.lpad(F.lower(F.hex(p * 7919)), 12, "0").alias("mac_raw"),
        F.concat(F.lit("run C:\\dir"), s(p), F.lit("\\a.exe --in D:\\x"), s(p % 3), F.lit(".txt /tmp/u"), s(p)).alias("cmd"),
        F.concat(F.lit("/usr/bin/p"), s(p), F.lit(" -x /tmp/u")).alias("cmd_unix"),
        F.concat(F.lit("Initial Access.T"), s(p)).alias("dotted"),
        F.concat(F.lit("Defense Evasion, Execution,Impact")).alias("tactics"),
        F.array(F.concat(F.lit("cve,CVE-2019-"), s(p)), F.lit("url,x"), F.concat(F.lit("cve,CVE-2020-"), s(p % 7))).alias("refs"),
        F.when(p % 5 == 0, F.lit("n/a")).otherwise(s(p * 123456789)).alias("bytes"),
        F.concat(F.lit("\"C:\\svc\\s"), s(p), F.lit(".exe\" -k x")).alias("svc"),
        F.concat(F.lit("1.3.6.1.2.1.25.2.1."), s(p % 12)).alias("oid"),
        F.concat(F.lit("0x"), F.hex(F.concat(F.lit("disk"), s(p)))).alias("hexdescr"),
        F.concat(F.lit("a%20b+c"), s(p)).alias("encoded"),
    )


def storage_type(oid) -> F.Column:
    """SCL-22: storage type OID -> name, other -> 'hrStorageOther'."""
    m = F.create_map(*[F.lit(x) for kv in C.STORAGE_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, oid), F.lit(C.STORAGE_TYPE_OTHER))


@register("scalar_functions", covers=("SCL-03", "SCL-04", "SCL-05", "SCL-06", "SCL-07", "SCL-09", "SCL-10",
                                      "SCL-13", "SCL-16", "SCL-17", "SCL-18", "SCL-20", "SCL-21", "SCL-22",
                                      "SCL-23", "SCL-30", "FLT-16", "FLT-17", "FLT-20"), oracle=f"""
WITH x AS (
  SELECT page_id AS p, url, page_id % 300 AS a, page_id % 256 AS b, (page_id * 7) % 256 AS c, page_id % 10 AS d
  FROM pages)
SELECT p AS page_id,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS authority,
  a <= 255 AS ip_valid,
  CASE WHEN a <= 255 THEN CAST(a * 16777216 + b * 65536 + c * 256 + d AS BIGINT) END AS ip_value,
  CASE WHEN a <= 255 THEN CAST(a * 16777216 + b * 65536 + c * 256 AS BIGINT) END AS net_lo,
  CASE WHEN a <= 255 THEN CAST(a * 16777216 + b * 65536 + c * 256 + 255 AS BIGINT) END AS net_hi,
  (a <= 255 AND (a IN (10, 127) OR (a = 192 AND b = 168) OR (a = 172 AND b BETWEEN 16 AND 31))) AS is_private,
  (a = 198 AND b = 51 AND c = 100) AS is_company,
  {O.MAC.format(m="lpad(lower(hex(p * 7919)), 12, '0')")} AS mac,
  concat('C:\\dir', p, '\\a.exe --in D:\\x', p % 3, '.txt ') AS win_paths,
  '' AS unix_paths_of_windows,
  concat('/usr/bin/p', p) AS unix_paths,
  concat('x', p % 3, '.txt ') AS file_name,
  substr(md5(url), 9, 16) AS url_key,
  concat('T', p) AS technique,
  'Defense Evasion|Execution|Impact' AS tactics,
  concat('CVE-2019-', p, ',CVE-2020-', p % 7) AS cves,
  CASE WHEN p % 5 = 0 THEN 'n/a' ELSE concat(CAST((p * 123456789) // 1073741824 AS VARCHAR), 'G') END AS size_g,
  concat('C:\\svc\\s', p, '.exe') AS service_path,
  [NULL, NULL, 'hrStorageRam', 'hrStorageVirtualMemory', 'hrStorgeFixedDisk', 'hrStorageRemovableDisk',
   'hrStorageFloppyDisk', 'hrStorageCompactDisc', 'hrStorageRamDisk', 'hrStorageFlashMemory',
   'hrStorageNetworkDisk', NULL][p % 12 + 1] AS storage_type0,
  concat('disk', p) AS description,
  concat('a b+c', p) AS decoded
FROM x
""".replace("AS storage_type0", "AS storage_type_raw"))
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _scalar_inputs(spark, sf_dir)
    lo, hi = N.mask_bounds(F.col("ip"), F.lit("255.255.255.0"))
    valid = N.is_valid_ipv4(F.col("ip"))
    return x.select(
        "page_id",
        T.url_authority(F.col("url")).alias("authority"),
        valid.alias("ip_valid"),
        F.when(valid, N.ip_to_long(F.col("ip"))).alias("ip_value"),
        F.when(valid, lo).alias("net_lo"), F.when(valid, hi).alias("net_hi"),
        N.is_private(F.col("ip")).alias("is_private"),
        N.in_range(F.col("ip"), "198.51.100.0", "198.51.100.255").alias("is_company"),
        N.normalise_mac(F.col("mac_raw")).alias("mac"),
        F.array_join(T.command_paths(F.col("cmd"), F.lit("Windows 10")), ",").alias("win_paths"),
        F.array_join(T.unix_paths(F.col("cmd")), ",").alias("unix_paths_of_windows"),
        F.array_join(T.command_paths(F.col("cmd_unix"), F.lit("Ubuntu")), ",").alias("unix_paths"),
        T.file_name_from_path(F.get(T.windows_paths(F.col("cmd")), 0)).alias("file_name"),
        T.rowkey_md5_mid(F.col("url")).alias("url_key"),
        T.dotted_part(F.col("dotted"), 2).alias("technique"),
        F.array_join(T.split_trim_first_space(F.col("tactics")), "|").alias("tactics"),
        F.array_join(T.cve_ids(F.col("refs")), ",").alias("cves"),
        T.bytes_to_g(F.col("bytes")).alias("size_g"),
        T.service_path(F.col("svc")).alias("service_path"),
        F.when(storage_type(F.col("oid")) == C.STORAGE_TYPE_OTHER, F.lit(None))
         .otherwise(storage_type(F.col("oid"))).alias("storage_type_raw"),
        T.hex_to_text(F.col("hexdescr")).alias("description"),
        T.percent_decode(F.col("encoded")).alias("decoded"),
    )


@register("syslog_line_parse", covers=("SCL-29", "Q15"), oracle="""
SELECT event_id,
  CASE WHEN event_id % 17 = 0 THEN '8'
       ELSE CAST(8 + [6, 4, 3, 7, 6][event_id % 5 + 1] AS VARCHAR) END AS pri,
  concat('Oct  9 22:33:', lpad(CAST(event_id % 60 AS VARCHAR), 2, '0'), ' host', user_id % 5) AS header,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('[', event_id % 1000, ']') END AS pid,
  CASE WHEN event_id % 17 = 0 THEN 'ecms_troubleshoot' ELSE concat('app', event_id % 3) END AS owner,
  concat('message ', event_id) AS msg
FROM events
""")
def syslog_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    lvl = F.element_at(F.array(*[F.lit(x) for x in ["INFO", "WARN", "ERROR", "DEBUG", "TRACE"]]), (e % 5 + 1).cast("int"))
    owner = F.when(e % 17 == 0, F.lit("ecms_troubleshoot")).otherwise(F.concat(F.lit("app"), (e % 3).cast("string")))
    pid = F.when(e % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("["), (e % 1000).cast("string"), F.lit("]")))
    line = F.concat(F.lit("Oct  9 22:33:"), F.lpad((e % 60).cast("string"), 2, "0"), F.lit(" host"),
                    (u % 5).cast("string"), F.lit(" "), owner, F.lit(": "), pid, F.lit("["), lvl, F.lit("] message "),
                    e.cast("string"))
    parsed = ev.select("event_id", T.parse_syslog_line(line).alias("r"))
    return parsed.select("event_id", F.col("r.PRI").alias("pri"), F.col("r.HEADER").alias("header"),
                         F.col("r.PID").alias("pid"), F.col("r.OWNER").alias("owner"), F.col("r.MSG").alias("msg"))



@register("fw_device_nodes", covers=("JOIN-08",), oracle="""
WITH hosts AS (SELECT DISTINCT concat('192.0.2.', event_id % 4) AS device FROM events
               WHERE event_type <> 'signup' AND event_id % 101 <> 0),
dev AS (SELECT concat('192.0.2.', r_regionkey) AS device_id, concat('r', r_regionkey) AS node_id FROM region
        WHERE r_regionkey < 3)
SELECT h.device, coalesce(d.node_id, '1') AS device_node_id FROM hosts h LEFT JOIN dev d ON d.device_id = h.device
""")
def fw_device_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import assets as A
    from .firewall_queries import classified

    hosts = classified(spark, sf_dir).filter(F.col("vendor").isNotNull() & F.col("host").isNotNull()) \
        .select(F.col("host").alias("device")).distinct()
    r = table(spark, sf_dir, "region").filter(F.col("r_regionkey") < 3)
    devices = r.select(F.concat(F.lit("192.0.2."), F.col("r_regionkey").cast("string")).alias("device_id"),
                       F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node_id"))
    return A.device_node(hosts, devices, "device").select("device", "device_node_id")


@register("cmdb_installed_extract", covers=("SCL-31", "JOIN-19", "SNK-12"), oracle=f"""
WITH {O.SOFT},
st AS (SELECT * FROM (VALUES ('0', 'system'), ('1', 'office'), ('2', 'network'), ('3', 'security'),
                             ('4', 'tools')) t(software_type_id, software_type_name)),
lib AS (SELECT concat('pkg', p_partkey) AS software_name, CAST(p_size % 5 AS VARCHAR) AS software_type_id FROM part)
SELECT i.asset_id, i.software_name, i.version, st.software_type_name,
       strftime(i.install_time, '%Y-%m-%d %H:%M:%S') AS install_time
FROM installed i LEFT JOIN lib l ON l.software_name = i.software_name
LEFT JOIN st ON st.software_type_id = l.software_type_id
""")
def cmdb_installed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lib = D.software_library(spark, sf_dir).join(D.software_types(spark), "software_type_id", "left") \
        .select("software_name", "software_type_name")
    inst = D.installed_software(spark, sf_dir)
    return inst.join(lib, "software_name", "left").select(
        "asset_id", "software_name", "version", "software_type_name",
        F.date_format("install_time", "yyyy-MM-dd HH:mm:ss").alias("install_time"))
