"""Firewall syslog queries: one classified frame feeds every output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import firewall as fw
from ..sources import derive
from .registry import register

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Oracle: the expected firewall facts computed straight from ``events`` (no parsing).
FW_CTE = """
fw AS (
  SELECT event_id, event_type, user_id, ts, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'click' THEN 'zhenguan' WHEN 'view' THEN 'hillstone'
         WHEN 'purchase' THEN 'star' WHEN 'error' THEN 'gap' END AS vendor,
    CASE event_type WHEN 'click' THEN '4' WHEN 'view' THEN '2' WHEN 'purchase' THEN '1' END AS fire_type,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('192.0.2.', event_id % 4) END AS host,
    CASE WHEN event_id % 50 = 0 THEN '' ELSE concat('10.', user_id // 256, '.', user_id % 256, '.1') END AS sip,
    CASE event_id % 3 WHEN 0 THEN concat('192.168.', event_id % 8, '.2')
                      WHEN 1 THEN concat('172.16.', event_id % 8, '.3')
                      ELSE concat('203.0.113.', event_id % 200) END AS dip,
    CASE WHEN event_type = 'purchase' THEN (CASE event_id % 3 WHEN 0 THEN 'AV' WHEN 1 THEN 'IPS' ELSE 'FILTER' END)
         WHEN event_type = 'click' THEN 'APP_POLICY' WHEN event_type = 'view' THEN 'NAT'
         WHEN event_type = 'error' THEN 'systemService' END AS log_type,
    CASE WHEN event_type IN ('click', 'view') OR (event_type = 'purchase' AND event_id % 3 < 2)
         THEN 1 ELSE 0 END AS black
  FROM events
),
fwa AS (SELECT *, (black = 1 AND sip <> '') AS accepted FROM fw)
"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fw.run(derive.firewall_topic(derive.table(spark, sf_dir, "events")))


@register("fw_vendor_daily", covers=("SRC-01", "FLT-01", "FLT-03", "FLT-04", "FLT-05", "FLT-06",
                                     "AGG-02", "AGG-04", "STR-09"), oracle=f"""
WITH {FW_CTE}
SELECT vendor, day, CAST(count(*) AS BIGINT) AS origin_count,
       CAST(sum(black) AS BIGINT) AS black_count,
       CAST(sum(CASE WHEN accepted THEN 1 ELSE 0 END) AS BIGINT) AS accepted_count
FROM fwa WHERE vendor IS NOT NULL GROUP BY vendor, day
""")
def fw_vendor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fw.vendor_daily_counts(classified(spark, sf_dir))


@register("fw_vendor_totals", covers=("AGG-03", "AGG-05"), oracle=f"""
WITH {FW_CTE}
SELECT vendor, CAST(count(*) AS BIGINT) AS origin_count, CAST(sum(black) AS BIGINT) AS black_count
FROM fwa WHERE vendor IS NOT NULL GROUP BY vendor
""")
def fw_vendor_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fw.vendor_lifetime_counts(classified(spark, sf_dir))


@register("fw_totals_rollup", covers=("AGG-06", "AGG-07"), oracle=f"""
WITH {FW_CTE}
SELECT day, CAST(count(*) AS BIGINT) AS origin_count, CAST(sum(black) AS BIGINT) AS black_count
FROM fwa GROUP BY ROLLUP (day)
""")
def fw_totals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fw.firewall_totals(classified(spark, sf_dir))


@register("fw_device_seen", covers=("AGG-01", "AGG-11"), oracle=f"""
WITH {FW_CTE}
SELECT vendor, host AS device_ip, CAST(count(*) AS BIGINT) AS origin_count,
       CAST(sum(black) AS BIGINT) AS black_count,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen
FROM fwa WHERE vendor IS NOT NULL GROUP BY vendor, host
""")
def fw_device_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fw.vendor_device_counts(classified(spark, sf_dir))
    return d.select("vendor", "device_ip", "origin_count", "black_count",
                    F.date_format("first_seen", TS_FMT).alias("first_seen"),
                    F.date_format("last_seen", TS_FMT).alias("last_seen"))


@register("fw_normalised", covers=("FLT-01", "FLT-02", "FLT-07", "FLT-08", "SCL-01", "SCL-02",
                                   "SCL-12", "SCL-28", "SNK-01", "SRC-16", "Q3", "Q16"), oracle=f"""
WITH {FW_CTE}
SELECT
  concat_ws('_', substr(md5(concat_ws(chr(1), 'origin_syslog', event_id % 8, event_id // 8)), 1, 4),
            reverse(strftime(ts, '%Y%m%d%H%M%S')), 'syslog') AS rowkey,
  host AS fire_host, vendor, fire_type, log_type,
  CAST(event_id % 8 AS BIGINT) AS severity, CAST(event_id % 24 AS BIGINT) AS facility,
  sip, dip, 'TCP' AS pro, CAST(1024 + event_id % 1000 AS VARCHAR) AS sport,
  CASE WHEN event_type = 'purchase' THEN '80' ELSE '443' END AS dport,
  CASE WHEN event_type = 'click' THEN 'a' ELSE '' END AS app,
  CASE event_type WHEN 'click' THEN 'deny' WHEN 'purchase' THEN 'PERMIT' ELSE '' END AS action,
  CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE '' END AS gentime,
  CASE WHEN event_type = 'purchase' THEN 'x' ELSE '' END AS content,
  CASE event_type WHEN 'click' THEN '7' WHEN 'purchase' THEN '9' ELSE '' END AS serialnum,
  CASE WHEN event_type = 'view' THEN '198.51.100.1' ELSE '' END AS aftertaddr,
  CASE WHEN event_type = 'view' THEN '39308' ELSE '' END AS aftertport,
  CAST(0 AS BIGINT) AS n_extras
FROM fwa WHERE accepted
""")
def fw_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fw.normalise(classified(spark, sf_dir))
    return n.select("rowkey", "fire_host", "vendor", "fire_type", "log_type",
                    F.col("severity").cast("long").alias("severity"),
                    F.col("facility").cast("long").alias("facility"),
                    "sip", "dip", "pro", "sport", "dport", "app", "action", "gentime", "content",
                    "serialnum", "aftertaddr", "aftertport",
                    F.size("extras").cast("long").alias("n_extras"))


@register("fw_topic_records", covers=("SNK-01",), oracle=f"""
WITH {FW_CTE}
SELECT fire_host, vendor, log_type, sip, dip, key_is_rowkey, n FROM (
  SELECT host AS fire_host, vendor, log_type, sip, dip, true AS key_is_rowkey, CAST(count(*) AS BIGINT) AS n FROM fwa WHERE accepted GROUP BY ALL)
""")
def fw_topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outgoing topic, read back: how many records carry each pair of addresses under their own key."""
    records = fw.to_topic_records(fw.normalise(classified(spark, sf_dir)))
    field = lambda n: F.get_json_object("value", f"$.{n}").alias(n)
    back = records.select("key", *(field(n) for n in ("rowkey", "fire_host", "vendor", "log_type", "sip", "dip")))
    return back.groupBy("fire_host", "vendor", "log_type", "sip", "dip", (F.col("key") == F.col("rowkey")).alias("key_is_rowkey")).agg(F.count("*").alias("n"))


@register("fw_quarantine_reasons", covers=("SNK-05", "SNK-06", "STR-13", "Q16"), oracle=f"""
WITH {FW_CTE}
SELECT coalesce(vendor, '') AS vendor,
       CASE WHEN vendor IS NULL THEN 'unclassified'
            WHEN vendor = 'gap' THEN 'detail_no_match'
            WHEN log_type = 'FILTER' THEN 'type_filtered'
            WHEN sip = '' THEN 'empty_srcip'
            ELSE 'accepted' END AS reason,
       CAST(count(*) AS BIGINT) AS n
FROM fwa GROUP BY 1, 2
""")
def fw_quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fw.reason_counts(classified(spark, sf_dir))
