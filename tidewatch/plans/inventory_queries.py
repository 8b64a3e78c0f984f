"""Inventory maintenance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assets as A
from ..operators import inventory as INV
from ..sources import dims as D
from ..sources import inventory as SI
from . import oracle_ctes as O
from .registry import register

CI_CTE = f"""
ip2a AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
         WHERE a.delete_state = '1' GROUP BY i.ip_addr),
ci AS (
  SELECT o_orderkey AS off, o_orderdate AS ts, o_custkey AS k, concat('agent-', o_custkey) AS uuid,
         concat('10.', o_custkey // 256, '.', o_custkey % 256, '.1') AS ip, lpad(lower(hex(o_custkey)), 12, '0') AS mac_raw,
         ['Windows 10 Pro', 'Ubuntu 18.04.3 LTS', 'CentOS Linux 7.6', 'other'][o_orderkey % 4 + 1] AS os_ver,
         CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '0' END AS delete_state,
         CASE WHEN o_orderstatus = 'O' THEN concat('srv', o_custkey % 4) END AS server_uid,
         concat('192.0.2.', o_custkey % 4) AS server_ip, concat('d', o_custkey % 25) AS group_id
  FROM orders
),
cires AS (SELECT ci.*, coalesce(a.asset_id, upper(md5(concat('iep', ci.uuid)))) AS asset_id
          FROM ci LEFT JOIN ip2a a ON a.ip_addr = ci.ip),
lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ts DESC, off DESC) AS rn
                       FROM cires) WHERE rn = 1)
"""


def _ctx(spark: SparkSession, sf_dir: str):
    lookup = A.ip_to_asset(D.asset_ips(spark, sf_dir), D.assets(spark, sf_dir))
    return lookup


def _client_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.client_changes(SI.client_info(spark, sf_dir), _ctx(spark, sf_dir))


@register("inv_asset_snapshot", covers=("UPS-02", "FLT-22", "JOIN-05", "WIN-01", "SRC-04"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE}
SELECT coalesce(s.asset_id, l.asset_id) AS asset_id,
       CASE WHEN l.asset_id IS NOT NULL THEN l.os_ver ELSE s.os_ver END AS os_ver,
       CASE WHEN l.asset_id IS NOT NULL THEN l.delete_state ELSE s.delete_state END AS delete_state,
       CASE WHEN l.asset_id IS NOT NULL THEN l.server_uid END AS server_uid,
       CASE WHEN s.asset_id IS NOT NULL AND l.asset_id IS NOT NULL THEN 'update'
            WHEN l.asset_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS _op
FROM assets s FULL JOIN lat l ON s.asset_id = l.asset_id
""")
def inv_asset_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.asset_snapshot(D.assets(spark, sf_dir), _client_changes(spark, sf_dir))


@register("inv_os_changes", covers=("SNK-09",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE}
SELECT l.uuid, s.asset_id, 'os_ver' AS type, s.os_ver AS old, l.os_ver AS new
FROM assets s JOIN lat l ON l.asset_id = s.asset_id WHERE s.os_ver IS DISTINCT FROM l.os_ver
""")
def inv_os_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.os_changes(D.assets(spark, sf_dir), _client_changes(spark, sf_dir))


@register("inv_os_transitions", covers=("WIN-04",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE},
seq AS (SELECT uuid, off, os_ver, lag(os_ver) OVER (PARTITION BY uuid ORDER BY ts, off) AS prev FROM ci)
SELECT uuid, off AS offset, prev AS old, os_ver AS new FROM seq WHERE prev IS NOT NULL AND prev <> os_ver
""")
def inv_os_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.os_transitions(_client_changes(spark, sf_dir))


@register("inv_asset_ips", covers=("UPS-03", "SCL-03", "SCL-05"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE},
chg AS (SELECT asset_id, ip AS ip_addr, {O.IPV.format(ip='ip')} AS ip_value, {O.MAC.format(m='mac_raw')} AS mac_addr
        FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, ip ORDER BY ts DESC, off DESC) AS rn FROM cires)
        WHERE rn = 1),
snap AS (SELECT asset_id, ip_addr, {O.IPV.format(ip='ip_addr')} AS ip_value, mac_addr FROM asset_ips)
SELECT coalesce(s.asset_id, c.asset_id) AS asset_id, coalesce(s.ip_addr, c.ip_addr) AS ip_addr,
       CASE WHEN c.asset_id IS NOT NULL THEN c.ip_value ELSE s.ip_value END AS ip_value,
       CASE WHEN c.asset_id IS NOT NULL THEN c.mac_addr ELSE s.mac_addr END AS mac_addr,
       CASE WHEN s.asset_id IS NOT NULL AND c.asset_id IS NOT NULL THEN 'update'
            WHEN c.asset_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS _op
FROM snap s FULL JOIN chg c ON s.asset_id = c.asset_id AND s.ip_addr = c.ip_addr
""")
def inv_asset_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.asset_ip_snapshot(D.asset_ips(spark, sf_dir), _client_changes(spark, sf_dir))


@register("inv_source_records", covers=("UPS-04", "JOIN-24"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE},
latu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY ts DESC, off DESC) AS rn
                        FROM cires) WHERE rn = 1),
rec AS (SELECT concat('agent-', c_custkey) AS uuid, asset_id AS old_asset_id FROM assets)
SELECT l.uuid, r.old_asset_id, l.asset_id AS new_asset_id,
       CASE WHEN r.old_asset_id IS NULL THEN 'insert' ELSE 'update' END AS _op
FROM latu l LEFT JOIN rec r ON r.uuid = l.uuid WHERE r.old_asset_id IS DISTINCT FROM l.asset_id
""")
def inv_source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = D.assets(spark, sf_dir)
    records = a.select(F.concat(F.lit("agent-"), F.col("c_custkey").cast("string")).alias("map_asset_id"),
                       F.col("asset_id").alias("first_asset_id"))
    return INV.source_record_changes(records, _client_changes(spark, sf_dir))


@register("inv_server_registry", covers=("UPS-05",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE},
x AS (SELECT * FROM ci WHERE server_uid IS NOT NULL),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY server_uid ORDER BY ts DESC, off DESC) AS rn FROM x)
      WHERE rn = 1)
SELECT l.server_uid, l.server_ip, strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS last_report,
       CAST((SELECT count(*) FROM x WHERE x.server_uid = l.server_uid) AS BIGINT) AS reports
FROM l
""")
def inv_server_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = INV.server_registry(_client_changes(spark, sf_dir))
    return r.select("server_uid", "server_ip", F.date_format("last_report", "yyyy-MM-dd HH:mm:ss").alias("last_report"),
                    F.col("reports").cast("long").alias("reports"))


@register("inv_asset_org", covers=("FLT-24", "UPS-01"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {CI_CTE},
orgn AS (SELECT DISTINCT concat('d', n_nationkey, '_192.0.2.', n_nationkey % 4) AS node_id FROM nation)
SELECT l.asset_id, concat(l.group_id, '_', l.server_ip) AS org_node_id,
       CASE WHEN o.node_id IS NOT NULL THEN o.node_id ELSE '1' END AS node_id
FROM lat l LEFT JOIN orgn o ON o.node_id = concat(l.group_id, '_', l.server_ip)
""")
def inv_asset_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = INV.latest_client_state(_client_changes(spark, sf_dir))
    nodes = INV.org_nodes(SI.organization(spark, sf_dir))
    return INV.attach_org(latest, nodes).select("asset_id", "org_node_id", "node_id")


@register("inv_org_nodes", covers=("UPS-01", "FLT-24"), oracle="""
SELECT DISTINCT concat('c', n_regionkey, '_192.0.2.', n_nationkey % 4) AS node_id, concat('company', n_regionkey) AS node_name,
       '1' AS parent_node_id, '1' AS node_type_id FROM nation
UNION ALL
SELECT concat('d', n_nationkey, '_192.0.2.', n_nationkey % 4), n_name,
       concat('c', n_regionkey, '_192.0.2.', n_nationkey % 4), '2' FROM nation
""")
def inv_org_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.org_nodes(SI.organization(spark, sf_dir))


SOFT_CTE = f"""
ip2a AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
         WHERE a.delete_state = '1' GROUP BY i.ip_addr),
msgs AS (SELECT DISTINCT a.asset_id, o.o_orderkey AS off, o.o_orderdate AS ts
         FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
         JOIN ip2a a ON a.ip_addr = concat('10.', o.o_custkey // 256, '.', o.o_custkey % 256, '.1')),
rep AS (
  SELECT m.asset_id, concat('pkg', l.l_partkey) AS software_name, CAST(l.l_quantity AS VARCHAR) AS version,
         strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS install_time, m.off, m.ts, l.l_linenumber AS pos
  FROM lineitem l JOIN msgs m ON l.l_orderkey = m.off WHERE l.l_partkey % 97 <> 0
)
"""


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.software_reports(SI.software_info(spark, sf_dir), _ctx(spark, sf_dir))


@register("inv_software_state", covers=("UPS-08", "UPS-09", "JOIN-26", "SET-03", "FLT-19", "AGG-18"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {O.SOFT}, {SOFT_CTE},
kk AS (SELECT asset_id, software_name, version FROM (
         SELECT *, row_number() OVER (PARTITION BY asset_id, software_name ORDER BY install_time DESC, version DESC) rn
         FROM installed) WHERE rn = 1),
rr AS (SELECT * FROM (
         SELECT *, row_number() OVER (PARTITION BY asset_id, software_name ORDER BY ts DESC, off DESC, pos DESC, version DESC) rn
         FROM rep) WHERE rn = 1),
lastm AS (SELECT asset_id, off FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY ts DESC, off DESC) rn FROM msgs)
          WHERE rn = 1),
names AS (SELECT asset_id, software_name FROM kk UNION SELECT asset_id, software_name FROM rr)
SELECT n.asset_id, n.software_name, coalesce(rr.version, kk.version) AS version,
       CASE WHEN m.asset_id IS NULL THEN '1'
            WHEN EXISTS (SELECT 1 FROM rep p WHERE p.asset_id = n.asset_id AND p.software_name = n.software_name AND p.off = m.off)
            THEN '1' ELSE '0' END AS install_state
FROM names n LEFT JOIN kk ON kk.asset_id = n.asset_id AND kk.software_name = n.software_name
LEFT JOIN rr ON rr.asset_id = n.asset_id AND rr.software_name = n.software_name
LEFT JOIN lastm m ON m.asset_id = n.asset_id
""")
def inv_software_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.software_state(D.installed_software(spark, sf_dir), _reports(spark, sf_dir))


@register("inv_software_orphans", covers=("SNK-05", "UPS-08"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {SOFT_CTE}
SELECT 'ACD_software_info' AS topic, CAST(o_orderkey AS BIGINT) AS offset, concat('agent-', o_custkey) AS uuid,
       concat('10.', o_custkey // 256, '.', o_custkey % 256, '.1') AS ip, 'unknown_address' AS reason, 1 AS attempts
FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
  AND o_orderkey NOT IN (SELECT off FROM msgs)
""")
def inv_software_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.orphans(_reports(spark, sf_dir)).select("topic", "offset", "uuid", "ip", "reason", "attempts")


@register("inv_host_orphans", covers=("SNK-05", "UPS-18", "UPS-19", "UPS-20"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS},
ip2a AS (SELECT DISTINCT i.ip_addr FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id WHERE a.delete_state = '1'),
e AS (SELECT *, concat('10.', user_id // 256, '.', user_id % 256, '.1') AS ip FROM events WHERE event_id % 4 < 3)
SELECT ['ACD_host_ports', 'ACD_host_service', 'ACD_host_proc'][event_id % 4 + 1] AS topic, event_id // 8 AS offset,
       concat('agent-', user_id) AS uuid, ip, 'unknown_address' AS reason, 1 AS attempts
FROM e WHERE ip NOT IN (SELECT ip_addr FROM ip2a)
""")
def inv_host_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, lookup = SI.host_activity(spark, sf_dir), _ctx(spark, sf_dir)
    parts = [INV.orphans(INV.host_messages(topic, t, lookup)) for t in ("ACD_host_ports", "ACD_host_service", "ACD_host_proc")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("topic", "offset", "uuid", "ip", "reason", "attempts")


@register("inv_hardware_orphans", covers=("SNK-05", "UPS-10", "FLT-12"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS},
ip2a AS (SELECT DISTINCT i.ip_addr FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id WHERE a.delete_state = '1'),
h AS (SELECT p_partkey, concat('10.', p_partkey // 256, '.', p_partkey % 256, '.1') AS ip FROM part WHERE p_partkey % 4 <> 3)
SELECT 'ACD_hardware_info' AS topic, concat('agent-', p_partkey) AS uuid, ip, 'unknown_address' AS reason, 1 AS attempts
FROM h WHERE ip NOT IN (SELECT ip_addr FROM ip2a)
""")
def inv_hardware_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hardware messages of three of the four endpoint servers whose address no asset has."""
    servers = tuple(f"192.0.2.{k}" for k in range(3))
    messages = INV.hardware_messages(SI.hardware_info(spark, sf_dir), _ctx(spark, sf_dir), servers)
    return INV.orphans(messages).select("topic", "uuid", "ip", "reason", "attempts")


@register("inv_software_library", covers=("UPS-06",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {O.SOFT},
{SOFT_CTE},
lib AS (SELECT upper(md5(concat('s', p_partkey))) AS software_id, concat('pkg', p_partkey) AS software_name,
               CASE WHEN p_partkey % 7 = 0 THEN '0' ELSE '1' END AS state FROM part),
nm AS (SELECT DISTINCT software_name FROM rep)
SELECT coalesce(l.software_id, upper(md5(concat('sw', n.software_name)))) AS software_id,
       coalesce(l.software_name, n.software_name) AS software_name,
       CASE WHEN n.software_name IS NOT NULL THEN '1' ELSE l.state END AS state,
       CASE WHEN l.software_name IS NOT NULL AND n.software_name IS NOT NULL THEN 'update'
            WHEN n.software_name IS NOT NULL THEN 'insert' ELSE 'keep' END AS _op
FROM lib l FULL JOIN nm n ON l.software_name = n.software_name
""")
def inv_software_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = INV.software_library(D.software_library(spark, sf_dir), INV.reported_software(_reports(spark, sf_dir)))
    return out.select("software_id", "software_name", "state", "_op")


@register("inv_software_history", covers=("UPS-07",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {O.SOFT},
{SOFT_CTE}
SELECT asset_id, software_name, version, install_time, off AS offset FROM rep
""")
def inv_software_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.reported_software(_reports(spark, sf_dir)).select("asset_id", "software_name", "version", "install_time", "offset")


def _hw_part(kind: str, key: str, where: str = "TRUE", **fields: str) -> str:
    columns = ", ".join(f"{fields.get(f, 'CAST(NULL AS VARCHAR)')} AS {f}" for f in INV.HARDWARE_FIELDS)
    return f"SELECT asset_id, '{kind}' AS hardware_type_id, {key} AS hw_key, {columns} FROM p WHERE {where}"


def _hw_sql() -> str:
    gb = "CAST(CAST(p_size AS BIGINT) * 1073741824 AS VARCHAR)"
    stick = lambda i, maker, where: _hw_part(
        "3", maker, where, manufacturer=maker, brand=f"concat('P{i}-', p_partkey)", serial_number=f"concat('M{i}-', p_partkey)",
        frequency="'2400'", capacity=gb)
    drive = lambda d: _hw_part("8", f"'dvd|{d}'", brand="'dvd'", cd_type="'DVD'", drive_letter=f"'{d}'")
    parts = [
        _hw_part("1", "p_brand", brand="p_brand", thread_num="CAST(p_partkey % 8 + 1 AS VARCHAR)",
                 core_num="CAST(p_partkey % 4 + 1 AS VARCHAR)", interface_type="'SOCKET 0'"),
        _hw_part("2", "concat('v', p_partkey % 5)", "p_partkey % 10 <> 7", manufacturer="p_type",
                 serial_number="CASE WHEN p_partkey % 9 <> 0 THEN concat('SN', p_partkey) END",
                 version="CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey % 4 AS VARCHAR) END",
                 bios_version="concat('v', p_partkey % 5)", bios_time="CASE WHEN p_partkey % 6 <> 0 THEN '2020-01-02' END"),
        _hw_part("6", "concat('gpu', p_partkey % 3)", brand="concat('gpu', p_partkey % 3)",
                 gcard_memory="CAST(p_partkey % 8 AS VARCHAR)", driver_version="'1.0'"),
        stick(0, "p_type", "p_partkey % 4 = 1"), stick(1, "p_type", "p_partkey % 4 >= 2"), stick(2, "p_brand", "p_partkey % 4 = 3"),
        _hw_part("5", "p_type", manufacturer="p_type", brand="concat('eth', p_partkey % 2)", mac_addr="lpad(hex(p_partkey), 12, '0')",
                 net_card_type="'LAN'", is_connecte="CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE '0' END"),
        _hw_part("4", "concat('disk', p_partkey % 2)", brand="concat('disk', p_partkey % 2)", firmware_version="'F1'",
                 capacity="CASE WHEN p_partkey % 13 = 0 THEN 'unknown' ELSE concat(p_size, 'G') END"),
        drive("E:"), drive("F:"), _hw_part("7", "'snd'", brand="'snd'", manufacturer="'maker'")]
    fields = ", ".join(f"coalesce(r.{f}, CASE WHEN r.asset_id IS NULL THEN s.{f} END) AS {f}" if f in ("brand", "manufacturer", "serial_number", "capacity")
                       else f"r.{f} AS {f}" for f in INV.HARDWARE_FIELDS)
    return f"""
WITH {O.ASSETS}, {O.ASSET_IPS},
ip2a AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
         WHERE a.delete_state = '1' GROUP BY i.ip_addr),
p AS (SELECT part.*, a.asset_id FROM part JOIN ip2a a
      ON a.ip_addr = concat('10.', p_partkey // 256, '.', p_partkey % 256, '.1')),
rep AS ({" UNION ALL ".join(parts)}),
snap AS (SELECT upper(md5(concat('c', p_partkey))) AS asset_id, CAST(p_partkey % 8 + 1 AS VARCHAR) AS hardware_type_id,
                p_brand AS brand, p_type AS manufacturer,
                CASE WHEN p_partkey % 9 = 0 THEN 'None' ELSE concat('SN', p_partkey) END AS serial_number,
                CAST(CAST(p_size AS BIGINT) * 1073741824 AS VARCHAR) AS capacity FROM part),
keyed AS (SELECT *, CASE WHEN hardware_type_id IN ('3', '5') THEN manufacturer WHEN hardware_type_id = '2' THEN '' ELSE brand END AS hw_key
          FROM snap)
SELECT coalesce(r.asset_id, s.asset_id) AS asset_id, coalesce(r.hardware_type_id, s.hardware_type_id) AS hardware_type_id,
       coalesce(r.hw_key, s.hw_key) AS hw_key, {fields},
       CASE WHEN r.asset_id IS NULL THEN 'keep' WHEN s.asset_id IS NULL THEN 'insert' ELSE 'update' END AS _op
FROM rep r FULL JOIN keyed s ON s.asset_id = r.asset_id AND s.hardware_type_id = r.hardware_type_id AND s.hw_key = r.hw_key
"""


@register("inv_hardware", covers=("UPS-10", "UPS-11", "UPS-12", "UPS-13", "UPS-14", "UPS-15", "UPS-16",
                                  "UPS-17", "FLT-21", "SCL-20", "Q10"), oracle=_hw_sql())
def inv_hardware(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = INV.hardware_rows(INV.hardware_messages(SI.hardware_info(spark, sf_dir), _ctx(spark, sf_dir)))
    return INV.hardware_state(D.hardware_details(spark, sf_dir), rows)


HOST_CTE = f"""
ip2a AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
         WHERE a.delete_state = '1' GROUP BY i.ip_addr),
h AS (SELECT e.*, e.event_id // 8 AS off,
             coalesce(a.asset_id, upper(md5(concat('iep', concat('agent-', e.user_id))))) AS asset_id,
             a.asset_id IS NOT NULL AS asset_known
      FROM events e LEFT JOIN ip2a a ON a.ip_addr = concat('10.', e.user_id // 256, '.', e.user_id % 256, '.1'))
"""


@register("inv_ports", covers=("UPS-20", "FLT-21"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {HOST_CTE}
SELECT asset_id, off AS offset, concat('10.', user_id // 256, '.', user_id % 256, '.1') AS sip, '198.51.100.7' AS dip,
       'TCP' AS proto, concat('p', event_id % 20) AS proc,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(1024 + event_id % 1000 AS INTEGER) END AS sport,
       CAST(443 AS INTEGER) AS dport
FROM h WHERE event_id % 4 = 0 AND asset_known
""")
def inv_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.ports(SI.host_activity(spark, sf_dir), _ctx(spark, sf_dir))


@register("inv_services", covers=("UPS-18", "SCL-21"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {HOST_CTE}
SELECT asset_id, off AS offset, concat('svc', event_id % 30) AS service, concat('Service ', event_id % 30) AS name,
       concat('C:\\svc\\s', event_id % 30, '.exe') AS path, 'running' AS status,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS systime
FROM h WHERE event_id % 4 = 1 AND asset_known
""")
def inv_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.services(SI.host_activity(spark, sf_dir), _ctx(spark, sf_dir))


@register("inv_processes", covers=("UPS-19",), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {HOST_CTE}
SELECT asset_id, off AS offset, CAST(event_id % 5000 AS VARCHAR) AS pid, concat('proc', event_id % 40) AS proc,
       'alive' AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS systime
FROM h WHERE event_id % 4 = 2 AND asset_known
""")
def inv_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.processes(SI.host_activity(spark, sf_dir), _ctx(spark, sf_dir))


@register("inv_vuln_rewrite", covers=("UPS-21", "SNK-10", "Q12"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {HOST_CTE}
SELECT off AS offset, concat('agent-', user_id) AS agent_uuid, asset_id AS asset_uuid,
       concat('CVE-2022-', event_id % 200) AS vuln_id, asset_known
FROM h WHERE event_id % 4 = 3
""")
def inv_vuln_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = INV.vulnerability_rewrite(SI.host_activity(spark, sf_dir), _ctx(spark, sf_dir))
    return v.select("offset", "agent_uuid", F.col("client.uuid").alias("asset_uuid"), "vuln_id", "asset_known")
