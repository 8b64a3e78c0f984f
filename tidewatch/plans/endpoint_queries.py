"""Endpoint-agent queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import standard_event as SE
from ..config import EngineParams
from ..operators import assets as A
from ..operators import attack as ATT
from ..operators import endpoint as EP
from ..operators import endpoint_event as EE
from ..sources import derive
from ..sources import dims as D
from . import oracle_ctes as O
from .event_oracles import endpoint_oracle
from .registry import register

# Fixture C3: allow-listed endpoint servers.
ALLOWED_SERVERS = ("192.0.2.0", "192.0.2.1", "192.0.2.2")
PARAMS = EngineParams(endpoint_server_allow_list=ALLOWED_SERVERS)

EP_CTE = """
ep AS (
  SELECT event_id AS e, user_id AS u, ts, CAST(ts AS DATE) AS day,
    ['eventlog', 'eventlog', 'eventlog', 'virus_defend', 'virus_detect', 'active_protect',
     'proc_protect'][event_id % 7 + 1] AS type,
    CASE WHEN event_id % 6 = 5 THEN '' ELSE ['trojan[suspicious-login]/a', 'worm/b', 'Ransom[DDoS]/c', 'unknown/d',
      'hacktool', 'exploit[network-scan]/e'][event_id % 6 + 1] END AS v_name,
    concat('10.', user_id // 256, '.', user_id % 256, '.1') AS cip
  FROM events WHERE event_id % 97 <> 0 AND user_id % 4 <> 3
),
epf AS (
  SELECT *, 1 AS k FROM ep
  UNION ALL SELECT *, 2 FROM ep WHERE type = 'virus_defend' AND u % 3 >= 1
  UNION ALL SELECT *, 3 FROM ep WHERE type = 'virus_defend' AND u % 3 >= 2
),
seen_new AS (SELECT DISTINCT concat('T', e % 30) AS t FROM ep WHERE type = 'eventlog' AND e % 30 >= 20),
new_ids AS (SELECT t, 20 + row_number() OVER (ORDER BY t) AS id FROM seen_new)
"""


def _standardised(spark: SparkSession, sf_dir: str, detailed: bool = False):
    topic = derive.endpoint_topic(derive.table(spark, sf_dir, "events"))
    good, bad = EP.decode(topic, whole=detailed)
    events = EP.gate(good, PARAMS)
    dictionary = D.attack_techniques(spark)
    # a set of names is the same with re-delivered messages in it, so these aren't shuffled a second time
    every = EP.gate(EP.decode(topic, dedupe=False)[0], PARAMS)
    names, addresses = EP.seen(every) if detailed else (EP.seen_techniques(every), None)
    new = ATT.register_new_techniques(names, dictionary, "attck_content")
    techniques = dictionary.select("attck_id", "attck_content").unionByName(new)
    # whole messages stream past the addresses of their partition; a merge would sort them, on disk if they are many
    lookup = asset_details(spark, sf_dir, addresses).hint("shuffle_hash") if detailed else _asset_detail_lookup(spark, sf_dir)
    return events, EP.standardise(EP.split_files(events), techniques, lookup), bad


def _asset_detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per active address: asset id, OS and unit (the asset's node name)."""
    from pyspark.sql import functions as F

    assets = D.assets(spark, sf_dir)
    ip2a = A.ip_to_asset(D.asset_ips(spark, sf_dir), assets)
    detail = assets.select("asset_id", "os_ver", "node_id").join(
        D.nodes(spark, sf_dir).select("node_id", F.col("node_name").alias("unit")), "node_id", "left").drop("node_id")
    return ip2a.join(detail, "asset_id", "left")


EVENT_CTES = f"""{O.ASSETS}, {O.ASSET_IPS}, {O.NODES}, {EP_CTE},
ip2a0 AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
          WHERE a.delete_state = '1' GROUP BY i.ip_addr),
ip2a AS (SELECT x.ip_addr, x.asset_id, a.os_ver, n.node_name AS unit FROM ip2a0 x JOIN assets a ON a.asset_id = x.asset_id
         LEFT JOIN nodes n ON n.node_id = a.node_id)"""

EVENT_SELECT = """SELECT
  concat(substr(md5(concat_ws(chr(1), 'iep_raw', e % 8, e // 8)), 1, 4), lpad(CAST(e // 8 AS VARCHAR), 12, '0'))
    AS rowkey,
  type, CASE WHEN type = 'eventlog' THEN concat('evt-', e) ELSE '' END AS eventlog_id, cip AS source_ip, v_name,
  CASE type WHEN 'eventlog' THEN concat('app', e, '+v.exe')
            WHEN 'proc_protect' THEN concat('child', e, '.exe') WHEN 'active_protect' THEN 'Run'
            ELSE concat('f', e, '_', k, '.doc') END AS file_name,
  CASE type WHEN 'eventlog' THEN concat('C:\\prog\\app', e, '.exe')
            WHEN 'proc_protect' THEN concat('C:\\tmp\\child', e, '.exe')
            WHEN 'active_protect' THEN 'HKLM\\Software\\Run'
            ELSE concat('C:\\data\\f', e, '_', k, '.doc') END AS file_path,
  CASE WHEN type = 'eventlog' AND v_name = '' THEN 'white' ELSE 'black' END AS route,
  CASE WHEN type = 'eventlog' THEN v_name <> '' ELSE type <> 'active_protect' END AS is_malicious,
  CASE type WHEN 'eventlog' THEN (CASE WHEN e % 4 = 0 THEN '源载荷' ELSE '目的载荷' END)
            WHEN 'virus_detect' THEN '源载荷' WHEN 'active_protect' THEN '目的载体' ELSE '目的载荷' END AS detect_obj,
  CASE WHEN (type = 'eventlog' AND e % 4 = 0) OR type = 'virus_detect' THEN 'source' ELSE 'purpose' END AS load_side,
  CASE WHEN type = 'eventlog' THEN ['初始访问', '执行', '持久化', '提权', '防御规避', '凭证访问', '发现', '横向运动',
       '收集', '命令控制', '渗透', '影响'][e % 12 + 1] ELSE '' END AS tactic,
  CASE WHEN type = 'eventlog' THEN CAST(e % 12 + 1 AS VARCHAR) ELSE '' END AS tactic_number,
  CASE WHEN type = 'eventlog' THEN concat('T', e % 30) ELSE '' END AS technique,
  CASE WHEN type <> 'eventlog' THEN '' WHEN e % 30 < 20 THEN CAST(e % 30 + 1 AS VARCHAR)
       ELSE CAST(n.id AS VARCHAR) END AS technique_number,
  CASE WHEN type = 'eventlog' THEN ['2', '3', '4', '5', '6', '1'][e % 6 + 1] ELSE '' END AS stage_number,
  CASE WHEN v_name LIKE 'trojan%' THEN '木马程序' WHEN v_name LIKE 'worm%' THEN '蠕虫程序'
       WHEN v_name = 'hacktool' THEN '黑客工具' WHEN v_name LIKE 'exploit%' THEN '溢出代码' ELSE '' END
    AS category_label,
  CASE WHEN v_name LIKE 'trojan%' THEN '可疑登录' WHEN v_name LIKE 'exploit%' THEN '网络扫描' ELSE '' END
    AS behaviour_label,
  a.asset_id IS NOT NULL AS asset_known,
  coalesce(a.asset_id, upper(md5(concat('iep', concat('agent-', u))))) AS asset_id,
  CASE WHEN type = 'eventlog' THEN concat('CVE-2021-', e % 50) END AS exploited_vuln,
  CASE WHEN a.asset_id IS NOT NULL THEN coalesce(a.os_ver, '') ELSE '' END AS asset_os,
  CASE WHEN a.asset_id IS NOT NULL THEN coalesce(a.unit, '')
       WHEN type = 'eventlog' THEN concat('unit', u % 3) ELSE '' END AS asset_unit
FROM epf LEFT JOIN ip2a a ON a.ip_addr = epf.cip
LEFT JOIN new_ids n ON n.t = concat('T', epf.e % 30)
"""


@register("endpoint_events", covers=("SRC-02", "STR-02", "FLT-12", "FLT-13", "FLT-14", "FLT-15",
                                     "DOM-22", "DOM-26",
                                     "JOIN-09", "JOIN-11", "JOIN-12", "JOIN-15", "SCL-08", "SCL-10", "SCL-11",
                                     "SCL-16", "DOM-29", "Q7"), oracle=f"WITH {EVENT_CTES} {EVENT_SELECT}")
def endpoint_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, std, _ = _standardised(spark, sf_dir)
    return std.select("rowkey", "type", "eventlog_id", "source_ip", "v_name", "file_name", "file_path",
                      "route", "is_malicious", "detect_obj", "load_side", "tactic", "tactic_number",
                      "technique", "technique_number", "stage_number", "category_label", "behaviour_label",
                      "asset_known", "asset_id", "exploited_vuln", "asset_os", "asset_unit")


def asset_details(spark: SparkSession, sf_dir: str, addresses: DataFrame | None = None) -> DataFrame:
    return A.asset_details(D.assets(spark, sf_dir), D.asset_ips(spark, sf_dir), D.nodes(spark, sf_dir), D.asset_types(spark, sf_dir),
                           D.asset_groups(spark), D.installed_software(spark, sf_dir), addresses)


@register("endpoint_standard_events", covers=("DOM-20", "DOM-21", "DOM-23", "DOM-24", "DOM-25", "DOM-27", "JOIN-15", "SCL-09", "SNK-02"),
          oracle=endpoint_oracle(EVENT_CTES, EVENT_SELECT))
def endpoint_standard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested standard event of every message; its populated leaves, part by part."""
    _, std, _ = _standardised(spark, sf_dir, detailed=True)
    return SE.sections(EE.standard_event(std), SE.ENDPOINT_PRODUCT, "rowkey", "route")


@register("endpoint_daily_counts", covers=("AGG-08",), oracle=f"""
WITH {EP_CTE}
SELECT o.day, o.origin_count, CAST(coalesce(b.black_count, 0) AS BIGINT) AS black_count
FROM (SELECT day, CAST(count(*) AS BIGINT) AS origin_count FROM ep GROUP BY day) o
LEFT JOIN (SELECT day, count(*) AS black_count FROM epf WHERE NOT (type = 'eventlog' AND v_name = '')
           GROUP BY day) b ON b.day = o.day
""")
def endpoint_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = derive.endpoint_topic(derive.table(spark, sf_dir, "events"))
    events = EP.gate(EP.decode(topic)[0], PARAMS)
    return EP.daily_counts(events)


@register("endpoint_dead_letters", covers=("SNK-06", "STR-13"), oracle="""
SELECT CAST(event_id % 8 AS INTEGER) AS partition, event_id // 8 AS offset, 'undecodable' AS reason
FROM events WHERE event_id % 97 = 0
""")
def endpoint_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, bad = _standardised(spark, sf_dir)
    return bad.select("partition", "offset", "reason")


@register("endpoint_new_techniques", covers=("DOM-29", "SET-04", "AGG-20", "AGG-22"), oracle=f"""
WITH {EP_CTE}
SELECT t AS attck_content, CAST(id AS BIGINT) AS attck_id FROM new_ids
""")
def endpoint_new_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = derive.endpoint_topic(derive.table(spark, sf_dir, "events"))
    events = EP.gate(EP.decode(topic)[0], PARAMS)
    return ATT.register_new_techniques(EP.seen_techniques(events), D.attack_techniques(spark), "attck_content")



@register("endpoint_asset_by_agent", covers=("JOIN-02",), oracle=f"""
WITH {O.ASSETS}, {EP_CTE},
rec AS (SELECT concat('agent-', c_custkey) AS map_asset_id, asset_id FROM assets)
SELECT e AS event_id, concat('agent-', u) AS uuid, r.asset_id AS mapped_asset_id
FROM ep LEFT JOIN rec r ON r.map_asset_id = concat('agent-', u)
""")
def endpoint_asset_by_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    topic = derive.endpoint_topic(derive.table(spark, sf_dir, "events"))
    events = EP.gate(EP.decode(topic)[0], PARAMS)
    recs = D.assets(spark, sf_dir).select(
        F.concat(F.lit("agent-"), F.col("c_custkey").cast("string")).alias("map_asset_id"),
        F.col("asset_id").alias("first_asset_id"))
    out = A.asset_by_source_id(events.select(((F.col("offset") * 8) + F.col("partition")).alias("event_id"),
                                             F.col("client.uuid").alias("uuid")), recs, "uuid")
    return out.select("event_id", "uuid", "mapped_asset_id")


@register("endpoint_vulnerabilities", covers=("DOM-24", "JOIN-15"), oracle=f"""
WITH {EP_CTE}
SELECT concat(substr(md5(concat_ws(chr(1), 'iep_raw', e % 8, e // 8)), 1, 4), lpad(CAST(e // 8 AS VARCHAR), 12, '0'))
         AS rowkey,
       concat('CVE-2021-', e % 50) AS vulne_id, 'vuln' AS vulne_name, concat('KB', e % 50) AS patch_id,
       'patch' AS patch_name, CAST(1 AS INTEGER) AS n_vulns
FROM ep WHERE type = 'eventlog'
""")
def endpoint_vulnerabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    topic = derive.endpoint_topic(derive.table(spark, sf_dir, "events"))
    events = EP.gate(EP.decode(topic)[0], PARAMS)
    v = EP.vulnerabilities(events)
    ex = v.select("rowkey", F.size("vulne_ids").alias("n_vulns"), F.explode("vulne").alias("x"))
    ex = ex.select("rowkey", "n_vulns", "x.vulne_id", "x.vulne_name", F.explode("x.patch_info").alias("p"))
    return ex.select("rowkey", "vulne_id", "vulne_name", F.col("p.patch_id").alias("patch_id"),
                     F.col("p.patch_name").alias("patch_name"), "n_vulns")
