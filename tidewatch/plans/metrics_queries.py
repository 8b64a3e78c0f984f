"""Operational metrics and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import endpoint as EP
from ..operators import firewall as fw
from ..operators import metrics as M
from ..operators import sensor as S
from ..operators import workbook as W
from ..sources import derive
from . import endpoint_queries as EQ
from .endpoint_queries import EP_CTE
from .firewall_queries import FW_CTE, classified
from .registry import register
from .sensor_queries import SN_CTE

# Report parameters for the fixtures: presence reference time, display names, sensors.
AS_OF = "2024-01-30 22:00:00"
DEVICE_NAMES = {"dev1": "Sensor One", "dev[23]": "Sensor Pair"}
SENSORS = [f"dev{i}" for i in range(6)]   # the others count as "other"
LOG_TYPES = ["APP_POLICY", "AV", "IPS", "NAT"]
TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"

DAILY_CTE = f"""
{FW_CTE}, {SN_CTE}, {EP_CTE},
fwd AS (SELECT day, count(*) AS o, sum(black) AS b FROM fwa GROUP BY day),
snd AS (SELECT day, count(*) AS o, sum(CASE WHEN not_hb AND black THEN 1 ELSE 0 END) AS b FROM sn GROUP BY day),
epo AS (SELECT day, count(*) AS o FROM ep GROUP BY day),
epb AS (SELECT day, count(*) AS b FROM epf WHERE NOT (type = 'eventlog' AND v_name = '') GROUP BY day),
epd AS (SELECT epo.day, epo.o, coalesce(epb.b, 0) AS b FROM epo LEFT JOIN epb ON epb.day = epo.day)
"""


def _sensor_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.decode_batches(derive.sensor_topic(derive.table(spark, sf_dir, "events")))


def _ep_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = EP.gate(EP.decode(derive.endpoint_topic(derive.table(spark, sf_dir, "events")))[0], EQ.PARAMS)
    return EP.daily_counts(events)


@register("report_daily_line", covers=("AGG-12", "SCL-27"), oracle=f"""
WITH {DAILY_CTE},
days AS (SELECT day FROM fwd UNION SELECT day FROM snd UNION SELECT day FROM epd)
SELECT strftime(d.day, '%Y%m%d') AS day_key,
  CAST(coalesce(f.o, 0) AS BIGINT) AS firewall_origin, CAST(coalesce(f.b, 0) AS BIGINT) AS firewall_black,
  CAST(coalesce(e.o, 0) AS BIGINT) AS iep_origin, CAST(coalesce(e.b, 0) AS BIGINT) AS iep_black,
  CAST(coalesce(s.o, 0) AS BIGINT) AS ptd_origin, CAST(coalesce(s.b, 0) AS BIGINT) AS ptd_black
FROM days d LEFT JOIN fwd f ON f.day = d.day LEFT JOIN epd e ON e.day = d.day LEFT JOIN snd s ON s.day = d.day
""")
def report_daily_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    return M.daily_report(fw.firewall_totals(c), _ep_daily(spark, sf_dir),
                          S.daily_counts(_sensor_decoded(spark, sf_dir)))


@register("report_daily_summary", covers=("AGG-13",), oracle=f"""
WITH {DAILY_CTE},
v AS (SELECT day, vendor AS source, count(*) AS o, sum(black) AS b FROM fwa WHERE vendor IS NOT NULL GROUP BY 1, 2),
rows_ AS (SELECT * FROM v UNION ALL SELECT day, 'iep', o, b FROM epd UNION ALL SELECT day, 'ptd', o, b FROM snd),
mt AS (SELECT day, sum(o) AS m FROM rows_ WHERE source IN ('star', 'hillstone') GROUP BY day)
SELECT r.day, r.source, CAST(r.o AS BIGINT) AS origin_count,
       CAST(CASE WHEN r.source IN ('star', 'hillstone') THEN mt.m ELSE r.o END AS BIGINT) AS total_count,
       CAST(r.b AS BIGINT) AS black_count
FROM rows_ r LEFT JOIN mt ON mt.day = r.day
""")
def report_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    return M.daily_summary(fw.vendor_daily_counts(c), _ep_daily(spark, sf_dir),
                           S.daily_counts(_sensor_decoded(spark, sf_dir)))


@register("report_device_counts", covers=("AGG-14", "JOIN-23", "WIN-03", "SRC-17"), oracle=f"""
WITH {SN_CTE}
SELECT dev AS device, CAST(count(*) AS BIGINT) AS origin_count,
       CAST(sum(CASE WHEN not_hb AND black THEN 1 ELSE 0 END) AS BIGINT) AS black_count,
       CASE WHEN regexp_matches(dev, '^.*dev1') THEN 'Sensor One' WHEN regexp_matches(dev, '^.*dev[23]')
            THEN 'Sensor Pair' ELSE dev END AS display_name
FROM sn GROUP BY dev
""")
def report_device_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _sensor_decoded(spark, sf_dir)
    black = S.not_heartbeat() & (F.coalesce("is_malicious", F.lit(False)) | F.coalesce("alert", F.lit(False)))
    out = M.device_counts(d, "dev", black, DEVICE_NAMES)
    return out.select("device", F.col("origin_count").cast("long").alias("origin_count"),
                      F.col("black_count").cast("long").alias("black_count"), "display_name")


def _ops_sql() -> str:
    metrics = {"total": "1", "black": "CASE WHEN not_hb AND black THEN 1 ELSE 0 END",
               "white": "CASE WHEN not_hb AND NOT black THEN 1 ELSE 0 END",
               "heartbeat": "CASE WHEN not_hb THEN 0 ELSE 1 END"}
    parts = []
    for m, expr in metrics.items():
        cols = ", ".join(f"CAST(coalesce(sum(CASE WHEN dev = '{d}' THEN {expr} END), 0) AS BIGINT) AS {d}"
                         for d in SENSORS)
        listed = ", ".join(repr(d) for d in SENSORS)
        other = f"CAST(coalesce(sum(CASE WHEN dev IS NULL OR dev NOT IN ({listed}) THEN {expr} END), 0) AS BIGINT) AS other"
        parts.append(f"SELECT '{m}' AS metric, {cols}, {other} FROM sn")
    return f"WITH {SN_CTE}\n" + "\nUNION ALL\n".join(parts)


@register("report_ops_matrix", covers=(), oracle=_ops_sql())
def report_ops_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _sensor_decoded(spark, sf_dir)
    hb = ~S.not_heartbeat()
    bl = F.coalesce("is_malicious", F.lit(False)) | F.coalesce("alert", F.lit(False))
    metrics = {"total": F.lit(1), "black": (~hb & bl).cast("int"), "white": (~hb & ~bl).cast("int"),
               "heartbeat": hb.cast("int")}
    return M.ops_matrix(d, "dev", SENSORS, metrics)


def _operations_sql() -> str:
    metrics = ["last_active", "origin_total", "origin_black", "origin_gray", "asset_count", "stand_black", "stand_gray"]
    return f"""
WITH {SN_CTE}, {EP_CTE},
ptd AS (
  SELECT 'ptd' AS family, sn.dev AS device, strftime(max(sn.ts), '%Y-%m-%d %H:%M:%S') AS last_active, CAST(count(*) AS VARCHAR) AS origin_total,
    CAST(count(*) FILTER (not_hb AND black) AS VARCHAR) AS origin_black, CAST(count(*) FILTER (not_hb AND NOT black) AS VARCHAR) AS origin_gray,
    CAST(count(DISTINCT CASE WHEN not_hb THEN sip END) AS VARCHAR) AS asset_count, CAST(count(*) FILTER (not_hb AND black) AS VARCHAR) AS stand_black,
    '0' AS stand_gray
  FROM sn GROUP BY sn.dev),
flagged AS (SELECT *, NOT (type = 'eventlog' AND v_name = '') AS bad, concat('192.0.2.', u % 4) AS device FROM epf),
iep AS (
  SELECT 'iep' AS family, device, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_active, CAST(count(*) FILTER (k = 1) AS VARCHAR) AS origin_total,
    CAST(count(*) FILTER (k = 1 AND bad) AS VARCHAR) AS origin_black, CAST(count(*) FILTER (k = 1 AND NOT bad) AS VARCHAR) AS origin_gray,
    CAST(count(DISTINCT u) AS VARCHAR) AS asset_count, CAST(count(*) FILTER (bad) AS VARCHAR) AS stand_black, CAST(count(*) FILTER (NOT bad) AS VARCHAR) AS stand_gray
  FROM flagged GROUP BY device),
wide AS (SELECT * FROM ptd UNION ALL SELECT * FROM iep)
{" UNION ALL ".join(f"SELECT family, device, '{m}' AS metric, {m} AS value FROM wide" for m in metrics)}
"""


@register("report_operations", covers=("AGG-15",), oracle=_operations_sql())
def report_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every figure of every sensor and endpoint server; heartbeats count as received only."""
    d = _sensor_decoded(spark, sf_dir)
    real = S.not_heartbeat()
    bad = F.coalesce("is_malicious", F.lit(False)) | F.coalesce("alert", F.lit(False))
    alerts = d.select(F.col("dev").alias("device"), F.col("timestamp").alias("ts"), F.when(real, bad).alias("bad"), F.lit(0).alias("part"),
                      F.when(real, F.col("src.ip")).alias("asset"))
    sensors = M.operations(alerts, "ptd", "part", F.col("bad"), F.coalesce("bad", F.lit(False)), F.col("asset"))
    messages = EP.gate(EP.decode(derive.endpoint_topic(derive.table(spark, sf_dir, "events")))[0], EQ.PARAMS)
    split = EP.split_files(messages, part="part")
    events = split.select(F.col("client.server_ip").alias("device"), F.col("timestamp").alias("ts"), "part", (EP.route_of(EP.malware_name()) == "black").alias("bad"),
                          F.col("client.uuid").alias("asset"))
    servers = M.operations(events, "iep", "part", F.col("bad"), F.lit(True), F.col("asset"))
    return sensors.unionByName(servers)


@register("report_fw_log_types", covers=("AGG-16", "Q14"), oracle=f"""
WITH {FW_CTE}
SELECT coalesce(host, '') AS device_ip, CAST(count(*) AS BIGINT) AS total,
  {", ".join(f"CAST(sum(CASE WHEN log_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS {t}" for t in LOG_TYPES)},
  CAST(sum(CASE WHEN log_type NOT IN ({", ".join(repr(t) for t in LOG_TYPES)}) THEN 1 ELSE 0 END) AS BIGINT) AS other
FROM fwa WHERE accepted GROUP BY 1
""")
def report_fw_log_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.log_type_matrix(fw.normalise(classified(spark, sf_dir)), LOG_TYPES)


def _seen(spark: SparkSession, sf_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """First and last report of each device, and the heartbeats; of the topics' messages from ``since`` on."""
    topics = derive.table(spark, sf_dir, "events")
    topics = topics if since is None else topics.where(F.col("ts") >= since)
    c = fw.run(derive.firewall_topic(topics)).filter(F.col("vendor").isNotNull() & F.col("host").isNotNull())
    fwseen = c.groupBy(F.col("vendor").alias("family"), F.col("host").alias("device")).agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
    d = S.decode_batches(derive.sensor_topic(topics))
    snseen = d.groupBy(F.lit("ptd").alias("family"), F.col("dev").alias("device")).agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
    events = EP.gate(EP.decode(derive.endpoint_topic(topics))[0], EQ.PARAMS)
    epseen = events.groupBy(F.lit("iep").alias("family"), F.col("client.uuid").alias("device")).agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
    hbs = d.filter(F.col("type") == "heartbeat").select(F.lit("ptd").alias("family"), F.col("dev").alias("device"),
                                                        F.col("timestamp").alias("ts"))
    return fwseen.unionByName(snseen).unionByName(epseen), hbs


SEEN_CTE = f"""
{FW_CTE}, {SN_CTE}, {EP_CTE},
seen AS (
  SELECT vendor AS family, host AS device, min(ts) AS first_seen, max(ts) AS last_seen FROM fwa
  WHERE vendor IS NOT NULL AND host IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT 'ptd', dev, min(ts), max(ts) FROM sn GROUP BY 2
  UNION ALL SELECT 'iep', concat('agent-', u), min(ts), max(ts) FROM ep GROUP BY 2
)
"""


@register("presence_online", covers=("STR-06", "STR-07", "STR-08", "SET-01", "SCL-26", "SRC-19"), oracle=f"""
WITH {SEEN_CTE},
bydata AS (SELECT family, device FROM seen
           WHERE epoch(last_seen) + 240 * 60 > epoch(TIMESTAMP '{AS_OF}')),
byhb AS (SELECT 'ptd' AS family, dev AS device FROM sn WHERE NOT not_hb GROUP BY dev
         HAVING epoch(max(ts)) BETWEEN epoch(TIMESTAMP '{AS_OF}') - 120 * 60 AND epoch(TIMESTAMP '{AS_OF}'))
SELECT family, device FROM bydata UNION SELECT family, device FROM byhb
""")
def presence_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp")
    # only messages of the window are decoded: the newest of a device that is online is one of them
    seen, hbs = _seen(spark, sf_dir, since=F.timestamp_seconds(F.unix_timestamp(as_of) - F.lit(C.PRESENCE_DATA_MINUTES * 60)))
    return M.online_set(M.presence_by_data(seen, as_of), M.presence_by_heartbeat(hbs, as_of))


@register("presence_listings", covers=("SRC-19", "STR-07"), oracle=f"""
WITH {SN_CTE}
SELECT 'ptd' AS family, dev AS device, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_score FROM sn WHERE NOT not_hb AND event_id % 50 <> 49
GROUP BY dev HAVING epoch(date_trunc('second', max(ts))) BETWEEN epoch(TIMESTAMP '{AS_OF}') - 120 * 60 AND epoch(TIMESTAMP '{AS_OF}')
""")
def presence_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices that a heartbeat listing of the last two hours names, with the newest one's time."""
    as_of = F.lit(AS_OF).cast("timestamp")
    scores = M.heartbeat_scores(derive.heartbeat_listings(derive.table(spark, sf_dir, "events")))
    low = F.timestamp_seconds(F.unix_timestamp(as_of) - F.lit(C.PRESENCE_HEARTBEAT_MINUTES * 60))
    out = M.scored_between(scores, low, as_of)
    return out.select("family", "device", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_score"))


@register("device_registry", covers=("UPS-26", "UPS-27", "AGG-11", "AGG-19"), oracle=f"""
WITH {SEEN_CTE}
SELECT device, upper(md5(family)) AS device_type_id, family,
       strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f') AS first_seen, strftime(last_seen, '%Y-%m-%d %H:%M:%S.%f') AS last_seen
FROM seen
""")
def device_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, _ = _seen(spark, sf_dir)
    _, devs = M.device_registry(seen)
    return devs.select("device", "device_type_id", "family", F.date_format("first_seen", TS).alias("first_seen"),
                       F.date_format("last_seen", TS).alias("last_seen"))


@register("report_heartbeats", covers=("SORT-02",), oracle=f"""
WITH {SN_CTE}
SELECT dev AS device, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_heartbeat FROM sn WHERE NOT not_hb GROUP BY dev
""")
def report_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, hbs = _seen(spark, sf_dir)
    return (hbs.groupBy("device").agg(F.max("ts").alias("last")).orderBy(F.col("last").desc())
            .select("device", F.date_format("last", TS).alias("last_heartbeat")))


REPORT_DAY = "2024-01-30"

_NAMED = "CASE WHEN regexp_matches(device, '^.*dev1') THEN 'Sensor One' WHEN regexp_matches(device, '^.*dev[23]') THEN 'Sensor Pair' ELSE device END"
_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _workbook_sql() -> str:
    titles = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in W.DAILY.items())
    listed = ", ".join(f"('{k}')" for k in W.DAILY)
    sides = "\n".join(f"""
UNION ALL SELECT '{f}_data', {_NAMED}, {_TIME.format("last_data")}, NULL, NULL FROM dev WHERE family = '{f}' AND last_data IS NOT NULL
UNION ALL SELECT '{f}_heartbeat', {_NAMED}, {_TIME.format("last_hb")}, NULL, NULL FROM dev WHERE family = '{f}' AND last_hb IS NOT NULL
UNION ALL SELECT '{f}_counts', {_NAMED}, CAST(o AS VARCHAR), CAST(b AS VARCHAR), NULL FROM dev WHERE family = '{f}' AND last_data IS NOT NULL""" for f in ("iep", "ptd"))
    return f"""
WITH {FW_CTE}, {SN_CTE}, {EP_CTE},
logs AS (
  SELECT vendor AS family, coalesce(host, '') AS device, ts, 1 AS o, black AS b FROM fwa WHERE vendor IS NOT NULL
  UNION ALL SELECT 'ptd', dev, ts, 1, CASE WHEN not_hb AND black THEN 1 ELSE 0 END FROM sn
  UNION ALL SELECT 'iep', concat('192.0.2.', u % 4), ts, CASE WHEN k = 1 THEN 1 ELSE 0 END, CASE WHEN type = 'eventlog' AND v_name = '' THEN 0 ELSE 1 END FROM epf),
d AS (SELECT family, device, max(ts) AS last_data, coalesce(sum(o) FILTER (CAST(ts AS DATE) = DATE '{REPORT_DAY}'), 0) AS o,
             coalesce(sum(b) FILTER (CAST(ts AS DATE) = DATE '{REPORT_DAY}'), 0) AS b FROM logs GROUP BY 1, 2),
h AS (SELECT 'ptd' AS family, dev AS device, max(date_trunc('second', ts)) AS last_hb FROM sn WHERE NOT not_hb AND event_id % 50 <> 49 GROUP BY dev),
dev AS (SELECT coalesce(d.family, h.family) AS family, coalesce(d.device, h.device) AS device, last_data, last_hb, o, b
        FROM d FULL JOIN h ON d.family = h.family AND d.device = h.device),
fam AS (SELECT l.family, coalesce(sum(d.o), 0) AS o, coalesce(sum(d.b), 0) AS b FROM (VALUES {listed}) l(family) LEFT JOIN d ON d.family = l.family GROUP BY 1)
SELECT 'daily' AS sheet, CASE family {titles} END AS a, CAST(o AS VARCHAR) AS b,
       CAST(CASE WHEN family IN ('star', 'hillstone') THEN (SELECT sum(o) FROM fam WHERE family IN ('star', 'hillstone')) ELSE o END AS VARCHAR) AS c,
       CAST(b AS VARCHAR) AS d FROM fam
UNION ALL SELECT 'online', family, {_NAMED}, NULL, NULL FROM dev
WHERE family <> 'zhenguan' AND device <> '' AND (epoch(last_data) + 240 * 60 > epoch(TIMESTAMP '{AS_OF}')
      OR epoch(last_hb) BETWEEN epoch(TIMESTAMP '{AS_OF}') - 120 * 60 AND epoch(TIMESTAMP '{AS_OF}'))
{sides}
"""


@register("report_workbook", covers=("SNK-11",), oracle=_workbook_sql())
def report_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the eight report sheets of one day."""
    firewalls = classified(spark, sf_dir).where(F.col("vendor").isNotNull()).select(
        F.col("vendor").alias("family"), F.col("host").alias("device"), F.col("timestamp").alias("ts"), F.lit(True).alias("origin"), (F.col("black") == 1).alias("black"))
    bad = F.coalesce("is_malicious", F.lit(False)) | F.coalesce("alert", F.lit(False))
    sensors = _sensor_decoded(spark, sf_dir).select(
        F.lit("ptd").alias("family"), F.col("dev").alias("device"), F.col("timestamp").alias("ts"), F.lit(True).alias("origin"), (S.not_heartbeat() & bad).alias("black"))
    messages = EP.gate(EP.decode(derive.endpoint_topic(derive.table(spark, sf_dir, "events")))[0], EQ.PARAMS)
    servers = EP.split_files(messages, part="part").select(
        F.lit("iep").alias("family"), F.col("client.server_ip").alias("device"), F.col("timestamp").alias("ts"), (F.col("part") == 0).alias("origin"),
        (EP.route_of(EP.malware_name()) == "black").alias("black"))
    beats = M.heartbeat_scores(derive.heartbeat_listings(derive.table(spark, sf_dir, "events")))
    fig = W.figures([firewalls, sensors, servers], beats, F.lit(REPORT_DAY).cast("date"))
    return W.sheets(fig, F.lit(AS_OF).cast("timestamp"), DEVICE_NAMES)
