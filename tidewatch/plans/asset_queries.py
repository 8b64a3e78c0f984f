"""Asset enrichment, discovery, organisation attribution and CMDB extract queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..operators import assets as A
from ..operators import firewall as fw
from ..sources import dims as D
from . import oracle_ctes as O
from .firewall_queries import FW_CTE, classified
from .registry import register


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.asset_profile(D.assets(spark, sf_dir), D.asset_ips(spark, sf_dir),
                           D.nodes(spark, sf_dir), D.node_types(spark), D.asset_types(spark, sf_dir),
                           D.asset_groups(spark), D.installed_software(spark, sf_dir))


OS_GROUP_SQL = """CASE WHEN a.os_ver LIKE 'Win%' THEN 'Windows'
            WHEN a.os_ver LIKE 'Ubuntu%' THEN 'Ubuntu 18.04'
            WHEN a.os_ver LIKE 'CentOS%' THEN 'CentOS 7' END"""


@register("asset_profile", covers=("JOIN-01", "JOIN-04", "JOIN-21", "JOIN-22", "AGG-17", "AGG-18",
                                   "AGG-23", "SCL-05", "SCL-19", "SRC-15", "JOIN-25"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {O.NODES}, {O.SOFT},
soft AS (SELECT asset_id, string_agg(DISTINCT software_name, ',' ORDER BY software_name) AS software_list,
                count(DISTINCT software_name) AS n_software FROM installed GROUP BY asset_id),
pairs AS (SELECT asset_id, string_agg(concat_ws('/', ip_addr, mac_addr), ','
                 ORDER BY concat_ws('/', ip_addr, mac_addr)) AS ip_mac_list FROM asset_ips GROUP BY asset_id)
SELECT i.ip_addr, a.asset_id, a.asset_name, a.os_ver, {OS_GROUP_SQL} AS os_group,
       n.node_name, nt.node_type_name, t.type_name, g.group_name, a.use_person,
       coalesce(s.software_list, '') AS software_list, CAST(coalesce(s.n_software, 0) AS BIGINT) AS n_software,
       p.ip_mac_list
FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
LEFT JOIN nodes n ON n.node_id = a.node_id
LEFT JOIN node_types nt ON nt.node_type_id = n.node_type_id
LEFT JOIN asset_types t ON t.type_id = a.type_id
LEFT JOIN asset_groups g ON g.group_id = i.group_id
LEFT JOIN soft s ON s.asset_id = a.asset_id
LEFT JOIN pairs p ON p.asset_id = a.asset_id
""")
def asset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


@register("fw_asset_enrich", covers=("JOIN-04", "JOIN-05", "WIN-02", "SORT-04"), oracle=f"""
WITH {FW_CTE}, {O.ASSETS}, {O.ASSET_IPS},
ip2a AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
         WHERE a.delete_state = '1' GROUP BY i.ip_addr)
SELECT concat_ws('_', substr(md5(concat_ws(chr(1), 'origin_syslog', event_id % 8, event_id // 8)), 1, 4),
                 reverse(strftime(ts, '%Y%m%d%H%M%S')), 'syslog') AS rowkey,
       f.sip, s.asset_id AS sip_asset_id, f.dip, d.asset_id AS dip_asset_id
FROM fwa f LEFT JOIN ip2a s ON s.ip_addr = f.sip LEFT JOIN ip2a d ON d.ip_addr = f.dip
WHERE f.accepted
""")
def fw_asset_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = fw.normalise(classified(spark, sf_dir)).select("rowkey", "sip", "dip")
    lookup = A.ip_to_asset(D.asset_ips(spark, sf_dir), D.assets(spark, sf_dir))
    out = A.enrich_sides(recs, lookup, {"sip": "sip", "dip": "dip"}, ["asset_id"])
    return out.select("rowkey", "sip", "sip_asset_id", "dip", "dip_asset_id")


@register("fw_new_assets", covers=("JOIN-06", "FLT-16", "JOIN-07", "UPS-22", "FLT-30", "SCL-15",
                                   "SET-02", "SCL-03", "SCL-04"), oracle=f"""
WITH {FW_CTE}, {O.ASSETS}, {O.ASSET_IPS}, {O.NETS},
seen AS (SELECT sip AS ip_addr, host FROM fwa WHERE accepted UNION ALL SELECT dip, host FROM fwa WHERE accepted),
cand AS (SELECT ip_addr, min(host) AS create_person FROM seen
         WHERE (ip_addr LIKE '10.%' OR ip_addr LIKE '192.168.%' OR ip_addr LIKE '172.16.%')
           AND ip_addr NOT IN (SELECT ip_addr FROM asset_ips)
         GROUP BY ip_addr),
{O.org_of('cand')}
SELECT upper(md5(concat('fw', c.ip_addr))) AS asset_id, c.ip_addr, coalesce(org.org_node_id, '1') AS node_id,
       '1' AS type_id, '3' AS asset_level, '4' AS source, coalesce(c.create_person, '') AS create_person,
       '1' AS group_id, '1' AS delete_state
FROM cand c LEFT JOIN org ON org.ip = c.ip_addr
""")
def fw_new_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = fw.normalise(classified(spark, sf_dir))
    cand = A.unknown_internal_addresses(recs, ["sip", "dip"], D.asset_ips(spark, sf_dir), "fire_host")
    return A.register_discovered(cand, D.node_networks(spark, sf_dir), C.SOURCE_FIREWALL, "fw")


@register("org_attribution", covers=("JOIN-07", "SET-02", "SCL-03", "SCL-04"), oracle=f"""
WITH {O.ASSET_IPS}, {O.NETS}, {O.org_of('asset_ips')}
SELECT i.asset_id, i.ip_addr, coalesce(org.org_node_id, '1') AS org_node_id
FROM asset_ips i LEFT JOIN org ON org.ip = i.ip_addr
""")
def org_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    ips = D.asset_ips(spark, sf_dir).select("asset_id", "ip_addr")
    return A.attribute_org(ips, D.node_networks(spark, sf_dir))


@register("cmdb_asset_extract", covers=("JOIN-18", "SNK-12"), oracle=f"""
WITH {O.ASSETS}, {O.NODES}
SELECT a.asset_id, a.asset_name, a.os_ver, t.type_name, n.node_name, a.delete_state
FROM assets a LEFT JOIN asset_types t ON t.type_id = a.type_id
LEFT JOIN nodes n ON n.node_id = a.node_id AND n.state = '1'
""")
def cmdb_asset_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cmdb_asset_extract(D.assets(spark, sf_dir), D.asset_types(spark, sf_dir),
                                D.nodes(spark, sf_dir))


@register("cmdb_software_extract", covers=("JOIN-19", "SNK-12"), oracle="""
WITH st AS (SELECT * FROM (VALUES ('0', 'system'), ('1', 'office'), ('2', 'network'), ('3', 'security'),
                                  ('4', 'tools')) t(software_type_id, software_type_name))
SELECT upper(md5(concat('s', p_partkey))) AS software_id, concat('pkg', p_partkey) AS software_name,
       p_brand AS publisher, st.software_type_name
FROM part LEFT JOIN st ON st.software_type_id = CAST(p_size % 5 AS VARCHAR)
""")
def cmdb_software_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cmdb_software_extract(D.software_library(spark, sf_dir), D.software_types(spark))


@register("cmdb_hardware_extract", covers=("JOIN-20", "SNK-12", "SCL-20", "FLT-21"), oracle="""
WITH ht AS (SELECT * FROM (VALUES ('1', 'cpu'), ('2', 'board'), ('3', 'memory'), ('4', 'disk'), ('5', 'netcard'),
                                  ('6', 'graphics'), ('7', 'sound')) t(hardware_type_id, hardware_type_name))
SELECT upper(md5(concat('c', p_partkey))) AS asset_id, CAST(p_partkey % 8 + 1 AS VARCHAR) AS hardware_type_id,
       ht.hardware_type_name, p_brand AS brand, p_type AS manufacturer,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('SN', p_partkey) END AS serial_number,
       concat(CAST(p_size AS VARCHAR), 'G') AS capacity
FROM part LEFT JOIN ht ON ht.hardware_type_id = CAST(p_partkey % 8 + 1 AS VARCHAR)
""")
def cmdb_hardware_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cmdb_hardware_extract(D.hardware_details(spark, sf_dir), D.hardware_types(spark))

