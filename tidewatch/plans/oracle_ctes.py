"""SQL building blocks for the DuckDB oracles: the derived dimensions written as plain SQL
from the driver tables (closed formulas, no shared code with the Spark side)."""

MAC = ("concat_ws('-', substr(upper({m}),1,2), substr(upper({m}),3,2), substr(upper({m}),5,2), "
       "substr(upper({m}),7,2), substr(upper({m}),9,2), substr(upper({m}),11,2))")

IPV = ("(CAST(split_part({ip},'.',1) AS BIGINT)*16777216 + CAST(split_part({ip},'.',2) AS BIGINT)*65536"
       " + CAST(split_part({ip},'.',3) AS BIGINT)*256 + CAST(split_part({ip},'.',4) AS BIGINT))")

ASSETS = """
assets AS (
  SELECT upper(md5(concat('c', c_custkey))) AS asset_id, CAST(c_nationkey AS VARCHAR) AS node_id,
         c_mktsegment AS type_id,
         CASE c_custkey % 4 WHEN 0 THEN 'Windows 10 Pro' WHEN 1 THEN 'Ubuntu 18.04.3 LTS'
              WHEN 2 THEN 'CentOS Linux 7.6' ELSE 'other' END AS os_ver,
         c_name AS asset_name, concat('user', c_custkey % 50) AS use_person,
         CASE WHEN c_acctbal < 0 THEN '0' ELSE '1' END AS delete_state, c_custkey
  FROM customer
)"""

ASSET_IPS = """
asset_ips_raw AS (
  SELECT upper(md5(concat('c', c_custkey))) AS asset_id,
         concat('10.', c_custkey // 256, '.', c_custkey % 256, CASE WHEN c_custkey % 3 = 0 THEN '.3' ELSE '.1' END) AS ip_addr,
         lpad(lower(hex(c_custkey)), 12, '0') AS mac_raw
  FROM customer
  UNION ALL
  SELECT upper(md5(concat('c', c_custkey))), concat('10.', c_custkey // 256, '.', c_custkey % 256, '.2'),
         lpad(lower(hex(c_custkey + 4096)), 12, '0')
  FROM customer WHERE c_custkey % 5 = 0
),
asset_ips AS (SELECT asset_id, ip_addr, """ + MAC.format(m="mac_raw") + """ AS mac_addr, '1' AS group_id
              FROM asset_ips_raw)"""

NODES = """
nodes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS node_id, n_name AS node_name, '2' AS node_type_id, '1' AS state FROM nation
  UNION ALL SELECT concat('r', r_regionkey), r_name, '1', '1' FROM region
),
node_types AS (SELECT * FROM (VALUES ('1', 'company'), ('2', 'department')) t(node_type_id, node_type_name)),
asset_types AS (SELECT DISTINCT c_mktsegment AS type_id, lower(c_mktsegment) AS type_name FROM customer),
asset_groups AS (SELECT * FROM (VALUES ('1', '内网资产'), ('2', '外网资产')) t(group_id, group_name))"""

NETS = """
nets AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS node_id, '0' AS data_type,
         167772160 + n_nationkey * 6 * 256 AS lo, 167772160 + (n_nationkey * 6 + 5) * 256 + 255 AS hi
  FROM nation
  UNION ALL SELECT CAST(n_nationkey AS VARCHAR), '1', 167772160 + n_nationkey * 6 * 256 + 1,
         167772160 + n_nationkey * 6 * 256 + 1 FROM nation WHERE n_nationkey % 4 = 0
  UNION ALL SELECT CAST(n_nationkey AS VARCHAR), '0', 167837696, 167837696 + 65535
  FROM nation WHERE n_nationkey < 2
)"""


def org_of(cand: str, ipcol: str = "ip_addr") -> str:
    """CTE ``org(ip, org_node_id)`` for the addresses of CTE ``cand``."""
    return f"""
org_hits AS (SELECT c.{ipcol} AS ip, n.node_id, n.data_type FROM {cand} c
             JOIN nets n ON {IPV.format(ip='c.' + ipcol)} BETWEEN n.lo AND n.hi),
org_inc AS (SELECT DISTINCT ip, node_id FROM org_hits WHERE data_type = '0'
            EXCEPT SELECT DISTINCT ip, node_id FROM org_hits WHERE data_type <> '0'),
org AS (SELECT ip, CASE WHEN count(*) = 1 THEN min(node_id) ELSE '1' END AS org_node_id
        FROM org_inc GROUP BY ip)"""


SOFT = """
installed AS (
  SELECT upper(md5(concat('c', o.o_custkey))) AS asset_id, concat('pkg', l.l_partkey) AS software_name,
         CAST(l.l_quantity AS VARCHAR) AS version, o.o_orderdate AS install_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
