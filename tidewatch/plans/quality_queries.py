"""Quarantine and bounded retry query (SNK-07, SRC-05, DOM-28, STR-12, Q9, Q12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assets as A
from ..operators import quality as Q
from ..operators import sensor as S
from ..sources import derive
from ..sources import dims as D
from . import oracle_ctes as O
from .registry import register
from .sensor_queries import SN_CTE

MAX_ATTEMPTS = 2


@register("sensor_asset_retry", covers=("SNK-07", "SRC-05", "DOM-28", "STR-12", "Q9", "Q12"), oracle=f"""
WITH {O.ASSETS}, {O.ASSET_IPS}, {SN_CTE},
active AS (SELECT i.ip_addr, min(i.asset_id) AS asset_id FROM asset_ips i JOIN assets a ON a.asset_id = i.asset_id
           WHERE a.delete_state = '1' GROUP BY i.ip_addr),
anyip AS (SELECT ip_addr, min(asset_id) AS asset_id FROM asset_ips GROUP BY ip_addr),
q AS (SELECT id, CASE WHEN swapped THEN dip ELSE sip END AS src_ip FROM sx)
SELECT q.id, q.src_ip, CASE WHEN n.asset_id IS NOT NULL THEN 'recovered' ELSE 'requeued' END AS outcome,
       n.asset_id, CASE WHEN n.asset_id IS NOT NULL THEN 0 ELSE 1 END AS attempt, 'black' AS route
FROM q LEFT JOIN active a ON a.ip_addr = q.src_ip LEFT JOIN anyip n ON n.ip_addr = q.src_ip
WHERE a.asset_id IS NULL
""")
def sensor_asset_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = S.standardise(derive.sensor_topic(derive.table(spark, sf_dir, "events")))
    a = alerts.select("id", F.col("src.ip").alias("src_ip"),
                      F.struct("is_malicious", "alert").alias("Used_by_ES_ExtendInfo"))
    active = A.ip_to_asset(D.asset_ips(spark, sf_dir), D.assets(spark, sf_dir))
    first = a.join(active.withColumnRenamed("ip_addr", "src_ip"), "src_ip", "left")
    quarantine = Q.to_quarantine(first.filter(F.col("asset_id").isNull()).drop("asset_id"), "asset")
    anyip = D.asset_ips(spark, sf_dir).groupBy("ip_addr").agg(F.min("asset_id").alias("asset_id"))

    def process(rows: DataFrame) -> DataFrame:
        j = rows.join(anyip.withColumnRenamed("ip_addr", "src_ip"), "src_ip", "left")
        return j.withColumn("_ok", F.col("asset_id").isNotNull())

    out = Q.retry(quarantine, process, MAX_ATTEMPTS)
    out = out.withColumn("route", Q.nested_verdict(out))
    return out.select("id", "src_ip", "outcome", "asset_id", "attempt", "route")
