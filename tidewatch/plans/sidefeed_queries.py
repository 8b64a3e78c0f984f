"""Side-feed queries: sandbox, traps, SNMP walks, drop folder, API payloads, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sidefeeds as SF
from ..sources import sidefeeds as SS
from ..sources.derive import table
from .registry import register

WATCHED = "uplink-7"


@register("sandbox_reports", covers=("SRC-07",), oracle="""
SELECT doc_id AS key, md5(text) AS md5, CASE WHEN n_chars % 2 = 0 THEN '1' ELSE '0' END AS trust,
       CASE WHEN doc_id % 4 <> 0 THEN '1' ELSE '0' END AS finished,
       CASE WHEN n_chars % 2 = 0 THEN 'black' ELSE 'white' END AS verdict
FROM documents
""")
def sandbox_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = SF.sandbox_reports(SS.sandbox_lines(spark, sf_dir))
    return r.select("key", "md5", "trust", "finished", "verdict")


TRAP_ORACLE = " UNION ALL ".join(f"""
SELECT s_suppkey * 10 + {i} AS key, concat('sw', s_suppkey) AS host,
  concat('UDP: [192.0.2.', s_suppkey % 4, ']:39561->[198.51.100.1]:162') AS transport,
  CASE WHEN (s_suppkey + {i}) % 2 = 0 THEN 'IF-MIB::linkDown' ELSE 'IF-MIB::linkUp' END AS trap_type,
  CASE WHEN s_suppkey % 5 = 0 THEN (CASE WHEN (s_suppkey + {i}) % 2 = 0 THEN 'down' ELSE 'up' END) END AS link_state,
  concat('DISMAN-EVENT-MIB::sysUpTimeInstance = 12:17:36:', s_suppkey % 60,
         ', SNMPv2-MIB::snmpTrapOID.0 = IF-MIB::', CASE WHEN (s_suppkey + {i}) % 2 = 0 THEN 'linkDown' ELSE 'linkUp' END,
         ', IF-MIB::ifDescr.{i} = ', CASE WHEN s_suppkey % 5 = 0 THEN 'uplink-7' ELSE 'eth{i}' END,
         ', IF-MIB::ifOperStatus.{i} = ', CASE WHEN (s_suppkey + {i}) % 2 = 0 THEN 'down' ELSE 'up' END) AS rendered,
  concat('enterprise=1.3.6.1.4.1.', s_suppkey, ' agent=192.0.2.', s_suppkey % 4, ' generic=',
         CASE WHEN (s_suppkey + {i}) % 2 = 0 THEN '2' ELSE '3' END, ' specific=0 uptime=', s_suppkey % 60) AS v1_line
FROM supplier""" for i in (1, 2, 3))


@register("trap_records", covers=("SRC-13", "FLT-26", "FLT-27", "FLT-28"), oracle=TRAP_ORACLE)
def trap_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = SF.trap_records(SS.trap_messages(spark, sf_dir))
    tt = SF.trap_type(F.col("varbinds"))
    k = (F.col("key") / 10).cast("long")
    generic = F.when(tt.endswith("linkDown"), "2").otherwise("3")
    return r.select("key", "host", "transport", tt.alias("trap_type"),
                    SF.link_state(F.col("varbinds"), WATCHED).alias("link_state"), "rendered",
                    SF.v1_trap_line(F.concat(F.lit("1.3.6.1.4.1."), k.cast("string")),
                                    F.regexp_extract("transport", r"\[([^\]]+)\]", 1), generic, F.lit("0"),
                                    F.regexp_extract(F.get(F.split(F.col("rendered"), ", "), 0), r":(\d+)$", 1))
                    .alias("v1_line"))


@register("snmp_interfaces", covers=("SRC-14", "DOM-30", "JOIN-16"), oracle=" UNION ALL ".join(f"""
SELECT concat('sw', s_suppkey) AS host, '{i}' AS if_index, 'eth{i}' AS name, '6' AS type, '1500' AS mtu,
       CAST(CAST({i} AS BIGINT) * 1000000000 AS VARCHAR) AS speed, concat('0x00163e', lpad(hex(s_suppkey * 4 + {i}), 6, '0')) AS mac,
       {f"concat('10.200.', s_suppkey % 256, '.{i}')" if i < 3 else 'NULL'} AS ip,
       {"'255.255.255.0'" if i < 3 else 'NULL'} AS mask
FROM supplier""" for i in (1, 2, 3)))
def snmp_interfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.interface_inventory(SS.snmp_walks(spark, sf_dir))


@register("snmp_storage", covers=("DOM-31", "SCL-22", "SCL-23"), oracle=" UNION ALL ".join(f"""
SELECT concat('sw', s_suppkey) AS host, '{j}' AS storage_index, '{t}' AS type, '{d}' AS descr,
       CAST(4096 * 1000 * (s_suppkey + {j}) AS BIGINT) AS size_bytes,
       CAST(4096 * 10 * (s_suppkey + {j}) AS BIGINT) AS used_bytes, CAST(0.01 AS DOUBLE) AS utilisation
FROM supplier""" for j, t, d in ((1, "hrStorageRam", "Physical memory"), (2, "hrStorgeFixedDisk", "/"),
                                 (3, "hrStorageOther", "/data"))))
def snmp_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.storage_inventory(SS.snmp_walks(spark, sf_dir))


@register("snmp_cpu", covers=("DOM-32",), oracle="""
SELECT concat('sw', s_suppkey) AS host, concat(s_suppkey % 100, ',', (s_suppkey * 2) % 100) AS loads,
       round((s_suppkey % 100 + (s_suppkey * 2) % 100) / 2.0, 4) AS avg_load, CAST(2 AS BIGINT) AS cores
FROM supplier
""")
def snmp_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = SF.cpu_load(SS.snmp_walks(spark, sf_dir))
    return c.select("host", "loads", "avg_load", F.col("cores").cast("long").alias("cores"))


@register("snmp_system", covers=("DOM-33",), oracle="""
SELECT concat('sw', s_suppkey) AS host,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Hardware: x86 Windows Version 6.1' ELSE 'Linux sw 4.19.0' END AS descr,
       concat('sw', s_suppkey) AS sys_name,
       CASE WHEN s_suppkey % 3 = 0 THEN 'windows' ELSE 'other' END AS os_family
FROM supplier
""")
def snmp_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.system_info(SS.snmp_walks(spark, sf_dir))


@register("dropfolder_pairs", covers=("SRC-10", "SRC-11", "SRC-12", "FLT-25", "JOIN-17", "STR-10"), oracle="""
SELECT concat('drop/', page_id % 10, '/cap', page_id) AS stem, concat('cap', page_id, '.pcap') AS filename,
       CAST(page_id % 100 AS VARCHAR) AS lineno, concat('t', page_id % 7) AS taskid, concat('g', page_id % 3) AS groupid,
       concat('unit', page_id % 5) AS danwei, concat('r', page_id % 11) AS ruleid, '2024-01-01 00:00:00' AS tasktime,
       concat('drop/', page_id % 10, '/cap', page_id, '.pcap') AS pcap_path
FROM pages WHERE page_id % 3 <> 0
""")
def dropfolder_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.pair_files(SS.drop_folder(spark, sf_dir))


@register("api_messages", covers=("SRC-06",), oracle="""
SELECT conv_id, turn, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS line
FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations)
""")
def api_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SF.api_messages(SS.api_payloads(spark, sf_dir)).select("conv_id", "turn", "line_no", "line")


@register("topic_snapshot", covers=("SRC-20",), oracle="""
SELECT concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), chr(9), 'event ', event_id, ' ', event_type) AS line FROM events
UNION ALL SELECT concat('total', chr(9), count(*)) FROM events
""")
def topic_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    topic = ev.select(F.col("ts").cast("timestamp").alias("timestamp"),
                      F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "), F.col("event_type"))
                      .alias("value"))
    return SF.topic_snapshot(topic, "timestamp", "value")
