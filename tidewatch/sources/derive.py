"""Deterministic security records derived from the driver tables.

The driver provides TPC-H-like tables plus ``events``; the telemetry the engine works on
(firewall lines, sensor alerts, endpoint events, asset and inventory messages, side feeds)
is derived from them with closed formulas, row for row, so that every query's work grows
with the input tables and an independent SQL oracle can compute the expected answer
straight from the source columns.  Each function is a lazy projection; only the three topics
made of ``events`` deal their narrow rows out first (``spread``).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import bind


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to the session's number of shuffle partitions by their key.  A file of some MB holds millions of narrow
    rows in a few splits, and each row becomes a message of a KB that is then parsed: the split isn't the measure of that work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _s(c) -> Column:
    return c.cast("string")


def idiv(c: Column, n: int) -> Column:
    """Integer division of a non-negative LONG (SQL ``div``)."""
    return ((c - c % n) / n).cast("long")


def user_ip(uid: Column) -> Column:
    """``10.(uid div 256).(uid % 256).1`` -- the address a user / customer key maps to."""
    return F.concat(F.lit("10."), _s(idiv(uid, 256)), F.lit("."), _s(uid % 256), F.lit(".1"))


def firewall_dst_ip(eid: Column) -> Column:
    return (F.when(eid % 3 == 0, F.concat(F.lit("192.168."), _s(eid % 8), F.lit(".2")))
             .when(eid % 3 == 1, F.concat(F.lit("172.16."), _s(eid % 8), F.lit(".3")))
             .otherwise(F.concat(F.lit("203.0.113."), _s(eid % 200))))


@functools.cache
def _firewall_line() -> tuple[Column, Column]:
    e = F.col("event_id")
    pri = (e % 24) * 8 + e % 8
    host = F.concat(F.lit("192.0.2."), _s(e % 4))
    sip = F.when(e % 50 == 0, F.lit("")).otherwise(user_ip(F.col("user_id")))
    dip = firewall_dst_ip(e)
    sport = _s(F.lit(1024) + e % 1000)
    gen = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    star_type = F.when(e % 3 == 0, "AV").when(e % 3 == 1, "IPS").otherwise("FILTER")
    body = (
        F.when(F.col("event_type") == "click", F.concat(
            F.lit("Jan  1 00:00:00 fw1 APP_POLICY: SerialNum=7 GenTime=\""), gen,
            F.lit("\" SrcIP="), sip, F.lit(" DstIP="), dip, F.lit(" ProtocolType=TCP SrcPort="), sport,
            F.lit(" DstPort=443 AppName=a Action=deny")))
        .when(F.col("event_type") == "view", F.concat(
            F.lit("Jan  1 00:00:00 1234567890123456(root) abcdef12 Traffic@FLOW: NAT: "), sip,
            F.lit(":"), sport, F.lit("->"), dip,
            F.lit(":443(TCP), snat to 198.51.100.1:39308, rule 12")))
        .when(F.col("event_type") == "purchase", F.concat(
            F.lit("Jan  1 00:00:00 fw2 "), star_type, F.lit(": SerialNum=9 GenTime=\""), gen,
            F.lit("\" SrcIP="), sip, F.lit(" DstIP="), dip, F.lit(" Protocol=TCP SrcPort="), sport,
            F.lit(" DstPort=80 Action=PERMIT Content=\"x\"")))
        .when(F.col("event_type") == "error", F.concat(
            F.lit("charset=[UTF-8] logType=[systemService] serviceName=[svc"), _s(e % 5), F.lit("]")))
        .otherwise(F.concat(F.lit("unclassified "), _s(e))))
    line = F.concat(F.lit("<"), _s(pri), F.lit(">"), body)
    return line, host


def firewall_topic(events: DataFrame) -> DataFrame:
    """Kafka-shaped frame ``(topic, partition, offset, timestamp, value)`` of firewall
    syslog envelopes, one per event.  Every 101st message is sent as raw text instead of
    the JSON envelope."""
    e = F.col("event_id")
    line, host = _firewall_line()
    return bind(spread(events, "event_id"), _line=line, _host=host).select(
        F.lit("origin_syslog").alias("topic"),
        (e % 8).cast("int").alias("partition"),
        idiv(e, 8).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(e % 101 == 0, F.col("_line")).otherwise(
            F.to_json(F.struct(F.col("_line").alias("data"), F.col("_host").alias("host")))).alias("value"),
        F.col("event_id"),
    )


# --- sensor alerts ----------------------------------------------------------------------

# FIXED VALUES (fixture design) -- malware names picked by ``event_id % 6``.
SENSOR_MALNAMES = ["trojan[suspicious-login]/a", "worm/b", "Ransom[DDoS]/c", "unknown/d", "hacktool",
                   "exploit[network-scan]/e"]
# protocol list per case ``event_id % 16``
SENSOR_PROTOS = ["HTTP", "DNS", "TCP", "HTTP", "SMTP", "IMAP", "FTP", "FTP", "SMB", "NFS", "TCP", "HTTP",
                 "FEIQ", "TCP", "TCP", "TCP"]
SENSOR_FILE_CASES = [3, 4, 5, 6, 7, 8, 9, 12, 13]
SENSOR_FILEINFO_CASES = SENSOR_FILE_CASES + [15]
SENSOR_SENGINE_CASES = [10, 11, 14]
SENSOR_MSG_CASES = [6, 7, 8, 9, 12]
SENSOR_STAGES = [("Engagement", "Delivery"), ("Presence", "Credential Access"), ("Effect", "Deny"),
                 ("Unknown", "x")]


def _pick(idx: Column, values: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)).otherwise(out)
    return out


@functools.cache
def sensor_event_struct() -> Column:
    """One sensor alert per event (fixture C2), as the struct the sensor emits."""
    e, u = F.col("event_id"), F.col("user_id")
    case = e % 16
    sip = user_ip(u)
    dip = firewall_dst_ip(e)
    incase = lambda cs: case.isin(*cs)
    malname = _pick(e % 6, SENSOR_MALNAMES)
    hit = [malname.alias("malname"), F.concat(F.lit("type"), _s(e % 3)).alias("virus_type"),
           F.concat(F.lit("fam"), _s(e % 4)).alias("virus_family"), F.lit("win").alias("virus_platform"),
           F.lit("behav").alias("virus_behaviors"), F.lit("ptd-rules").alias("author"),
           F.concat(F.lit("r"), _s(e % 100)).alias("rid")]
    file_md5 = F.md5(F.concat(F.lit("f"), _s(e)))
    info_md5 = F.when(e % 4 != 0, file_md5).otherwise(F.md5(F.concat(F.lit("g"), _s(e))))
    stage = e % 4
    attacker = (F.when(u % 3 == 0, F.array(dip)).when(u % 3 == 1, F.array(sip))
                 .otherwise(F.lit(None).cast("array<string>")))
    sengine = F.struct(
        *hit,
        F.when(case == 10, "Huawei x")
         .when(case == 11, F.when(u % 2 == 0, "SQL x").otherwise("xss"))
         .otherwise("other").alias("msg"),
        F.when(case == 11, "web-application-attack").otherwise("misc-activity").alias("classtype"),
        F.struct(attacker.alias("attacker")).alias("related"),
        F.array(F.struct(_pick(stage, [s for s, _ in SENSOR_STAGES]).alias("stage"),
                         _pick(stage, [o for _, o in SENSOR_STAGES]).alias("objective"),
                         F.lit("act").alias("action"))).alias("nsacss"),
        F.array(F.struct(F.when(e % 3 == 0, "Defense Evasion, Execution")
                          .otherwise("Command and Control").alias("tactic"),
                         F.concat(F.lit("T"), _s(F.lit(1000) + e % 25)).alias("techniques"))).alias("attck"),
        F.array(F.concat(F.lit("cve,CVE-2020-"), _s(e % 100)), F.lit("url,http://ref.example/x"))
         .alias("reference"))
    empty = lambda t: F.array().cast(t)
    d = F.when(case != 15, F.struct(
        F.when(case == 0, F.array(F.struct(*hit))).alias("url"),
        F.when(case == 1, F.array(F.struct(*hit))).alias("domain"),
        F.when(case == 2, F.array(F.struct(*hit))).alias("ip"),
        F.when(incase(SENSOR_FILE_CASES), F.array(F.struct(*hit, file_md5.alias("md5")))).alias("file"),
        F.when(incase(SENSOR_SENGINE_CASES), F.array(sengine)).alias("sengine")))
    body = lambda tag, direction, md5: F.struct(
        _s(e % 1000).alias("bytes"), F.lit(direction).alias("direction"),
        F.concat(F.lit(tag), _s(e), F.lit(".bin")).alias("fn"), F.lit("bin").alias("ft"), md5.alias("md5"))
    up_md5 = F.when(case == 7, F.lit("")).otherwise(F.md5(F.concat(F.lit("u"), _s(e))))
    endpoint = lambda ip, port, unit, lon, lat: F.struct(
        ip.alias("ip"), port.alias("port"), F.lit("00-11-22-33-44-55").alias("mac"), F.lit("CN").alias("country"),
        F.concat(F.lit("city"), _s(u % 5)).alias("city"), F.lit("r1").alias("region"), unit.alias("unit"),
        F.lit("isp").alias("isp"), F.struct(lon.alias("lon"), lat.alias("lat")).alias("location"))
    return F.struct(
        F.concat(F.lit("ptd-"), _s(e)).alias("id"),
        F.concat(F.lit("dev"), _s(u % 8)).alias("dev"),
        F.when(F.col("event_type") == "signup", "heartbeat").otherwise("alert").alias("type"),
        (F.col("value") > 50).alias("is_malicious"),
        (F.col("event_type") == "error").alias("alert"),
        F.when(e % 10 == 3, "跨境通讯").otherwise("").alias("label"),
        F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("start")).alias("ts"),
        F.array(_pick(case, SENSOR_PROTOS)).alias("proto"),
        F.when(case == 8, F.array(F.lit("Virus/x"))).when(case == 9, F.array(F.lit("Trojan/x")))
         .otherwise(empty("array<string>")).alias("malname"),
        endpoint(sip, _s(F.lit(1024) + e % 1000),
                 F.when(u % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("unit"), _s(u % 4))),
                 _s(F.lit(100) + u % 10), _s(F.lit(30) + u % 7)).alias("src"),
        endpoint(dip, F.lit("443"), F.lit("ext"), F.lit("120"), F.lit("35")).alias("dst"),
        F.struct((e % 4).alias("pkts"), ((e % 4) * 100).alias("bytes")).alias("s2c"),
        F.when(incase([0, 3]), F.array(F.concat(F.lit("http://c2.example.com:8080/p%20"), _s(e), F.lit("+q"))))
         .otherwise(empty("array<string>")).alias("url"),
        F.when(incase([1, 11]), F.array(F.concat(F.lit("d"), _s(e % 50), F.lit(".example.org"))))
         .otherwise(empty("array<string>")).alias("domain"),
        F.when(incase(SENSOR_FILEINFO_CASES), F.array(F.struct(
            info_md5.alias("md5"), F.concat(F.lit("a%20"), _s(e), F.lit(".exe")).alias("name"),
            _s(e % 1000).alias("bytes"), F.lit("PE").alias("type"),
            F.when(e % 2 == 0, "up").otherwise("down").alias("direction")))).alias("file"),
        F.when(e % 5 == 0, F.array(F.struct(F.struct(sip.alias("name")).alias("victim"))))
         .when(e % 5 == 1, F.array(F.struct(F.struct(dip.alias("name")).alias("victim"))))
         .otherwise(F.array().cast("array<struct<victim:struct<name:string>>>")).alias("avlist"),
        d.alias("d"),
        F.when(case == 1, F.struct(F.struct(
            F.when(e % 2 == 0, "query").otherwise("response").alias("msg_type"),
            F.array(F.struct(F.lit("A").alias("Rtype"), F.lit("IN").alias("class"), F.lit("").alias("cname"),
                             dip.alias("data"))).alias("record")).alias("msg"))).alias("dns"),
        F.when(incase([4, 5]), F.struct(F.struct(
            F.lit("a@example.com").alias("from"), F.array(F.lit("b@example.com")).alias("to"),
            F.lit("a").alias("sender"), F.concat(F.lit("sub"), _s(e)).alias("sub"), F.lit("c").alias("content"),
            F.array(F.struct(file_md5.alias("md5"), F.lit("m.doc").alias("fn"), F.lit("doc").alias("ft")))
             .alias("attach")).alias("msg"))).alias("email"),
        F.when(incase([6, 7]), F.struct(body("dl", "down", file_md5).alias("download"),
                                        body("ul", "up", up_md5).alias("upload"))).alias("ftp"),
        F.when(incase([0, 3, 11]), F.struct(
            F.struct(F.lit("GET").alias("method"),
                     F.struct(F.lit("c2.example.com").alias("host"), F.concat(F.lit("/p"), _s(e)).alias("uri"),
                              F.array(F.struct(F.lit("User-Agent").alias("key"), F.lit("ua").alias("value")),
                                      F.struct(F.lit("Accept").alias("key"), F.lit("*/*").alias("value")),
                                      F.struct(F.lit("").alias("key"), F.lit("").alias("value")),
                                      F.struct(F.lit("X-After").alias("key"), F.lit("y").alias("value")))
                               .alias("other")).alias("header"),
                     body("req", "up", file_md5).alias("body")).alias("request"),
            F.struct(F.struct(F.array(F.struct(F.lit("Server").alias("key"), F.lit("srv").alias("value")))
                              .alias("other")).alias("header"),
                     body("resp", "down", file_md5).alias("body")).alias("response"))).alias("http"),
        F.when(incase(SENSOR_MSG_CASES), F.struct(body("ul", "up", up_md5).alias("upload"),
                                                  body("dl", "down", file_md5).alias("download"))).alias("msg"),
    )


def sensor_topic(events: DataFrame) -> DataFrame:
    """Kafka-shaped frame of sensor batches ``{"data": [alert]}``, one alert per event."""
    e = F.col("event_id")
    return spread(events, "event_id").select(
        F.lit("ptd_raw").alias("topic"),
        (e % 8).cast("int").alias("partition"),
        idiv(e, 8).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(F.array(sensor_event_struct()).alias("data"))).alias("value"),
    )


def heartbeat_listings(events: DataFrame) -> DataFrame:
    """One listing for each heartbeat: a JSON object whose keys are the sensors that answered, here the
    sensor of the row and a state that nobody reads; every 50th is not an object."""
    e, u = F.col("event_id"), F.col("user_id")
    value = F.to_json(F.create_map(F.concat(F.lit("dev"), _s(u % 8)), F.lit("up")))
    return events.where("event_type = 'signup'").select(
        F.lit("ptd").alias("family"), F.col("ts").cast("timestamp").alias("timestamp"), F.when(e % 50 == 49, "[]").otherwise(value).alias("value"))


# --- endpoint agent events ----------------------------------------------------------------

ENDPOINT_TYPES = ["eventlog", "eventlog", "eventlog", "virus_defend", "virus_detect", "active_protect",
                  "proc_protect"]
# local tactic names in tactic-number order, local kill-chain stage names (fixture choice)
ENDPOINT_TACTICS = ["初始访问", "执行", "持久化", "提权", "防御规避", "凭证访问", "发现", "横向运动", "收集",
                    "命令控制", "渗透", "影响"]
ENDPOINT_STAGES = ["准备", "交互", "存在", "影响", "持续", "管理"]


@functools.cache
def endpoint_event_struct() -> Column:
    """One endpoint-agent message per event (fixture C3)."""
    e, u = F.col("event_id"), F.col("user_id")
    etype = _pick(e % 7, ENDPOINT_TYPES)
    v_name = F.when(e % 6 == 5, F.lit("")).otherwise(_pick(e % 6, SENSOR_MALNAMES))
    cip = user_ip(u)
    path = F.concat(F.lit("C%3A%5Cprog%5Capp"), _s(e), F.lit(".exe"))
    name = F.concat(F.lit("app"), _s(e), F.lit("%2Bv.exe"))
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    md5 = F.md5(F.concat(F.lit("p"), _s(e)))
    tactic = _pick(e % 12, ENDPOINT_TACTICS)
    stage = _pick(e % 6, ENDPOINT_STAGES)
    vul = lambda i: F.struct(F.concat(F.lit("CVE-2021-"), _s(e % 50 + i)).alias("1"))
    data = F.struct(
        F.concat(F.lit("evt-"), _s(e)).alias("a"), ts.alias("b"),
        F.struct(F.lit("malware").alias("1"), F.lit("trojan").alias("2"), F.lit("l3").alias("3"),
                 F.lit("l4").alias("4")).alias("c"),
        F.struct(F.array(F.struct(cip.alias("1"), F.lit("00-1A-2B-3C-4D-5E").alias("2"))).alias("1")).alias("d"),
        F.array(F.struct(_s(e % 9000).alias("1"), F.struct(md5.alias("1")).alias("2"),
                         F.array(vul(0)).alias("3"), F.lit("on").alias("p"))).alias("e"),
        F.struct(F.struct(F.lit("t1").alias("1"), F.lit("t2").alias("2"), F.lit("exec").alias("3"),
                          F.lit("t4").alias("4")).alias("1"),
                 F.struct(F.concat(F.lit("CVE-2021-"), _s(e % 50)).alias("1")).alias("2"),
                 F.lit("high").alias("3"), F.lit("blocked").alias("4"),
                 F.concat(stage, F.lit(".obj.act")).alias("5"),
                 F.concat(tactic, F.lit("."), F.lit("T"), _s(e % 30)).alias("7")).alias("f"),
        F.array(F.struct(F.when(u % 2 == 0, F.array(vul(1), vul(0))).otherwise(F.array(vul(1))).alias("3"),
                         F.lit("off").alias("p"))).alias("g"),
        F.when(e % 5 == 0, F.struct(
            F.struct(F.lit("HKCU\\x").alias("1"), F.concat(F.lit("k"), _s(e)).alias("2"), F.lit("v").alias("3")).alias("1"),
            F.when(e % 10 == 0, F.struct(F.lit("task").alias("1"), F.lit("run").alias("2"), F.lit("C:\\t").alias("3"),
                                         F.lit("-x").alias("4"))).alias("2"),
            ts.alias("3"), F.lit("mid").alias("4"))).alias("h"),
        F.struct(
            F.array(F.struct(_s(e % 9000).alias("1"),
                             F.struct(md5.alias("1"), F.lit("sha1").alias("2"), F.lit("sha256").alias("3")).alias("2"),
                             path.alias("3"), name.alias("4"),
                             F.concat(F.lit("cmd /c C:\\prog\\app"), _s(e), F.lit(".exe --x /tmp/f"), _s(e))
                              .alias("5"),
                             _s(e % 1000).alias("6"), F.lit("PE").alias("7"), v_name.alias("8"),
                             F.when(e % 2 == 0, "Windows").otherwise("Linux").alias("9"),
                             F.concat(F.lit("L"), _s(e % 3)).alias("a"), ts.alias("b"), ts.alias("c"),
                             F.concat(F.lit("act"), _s(e % 4)).alias("e"),
                             F.struct(_s(e % 700).alias("1"), F.concat(F.lit("par%2Bent"), _s(e), F.lit(".exe")).alias("2"),
                                      F.concat(F.lit("C%3A%5Cpar"), _s(e)).alias("3"),
                                      F.struct(F.md5(F.concat(F.lit("q"), _s(e))).alias("1"), F.lit("psha1").alias("2"),
                                               F.lit("psha256").alias("3")).alias("4")).alias("g"),
                             F.struct(F.lit("auth").alias("1"), F.lit("upd").alias("2"), F.concat(F.lit("Comp"), _s(e % 9)).alias("3"),
                                      F.lit("cre").alias("4"), F.concat(F.lit("1."), _s(e % 5)).alias("5"), F.lit("vis").alias("6")).alias("h"),
                             F.when(e % 2 == 0, F.struct(F.concat(F.lit("sig"), _s(e)).alias("7"), F.lit("sigtime").alias("8"))).alias("i"),
                             F.when(e % 3 == 0, "dyn").alias("j"), F.concat(F.lit("init"), _s(e % 2)).alias("k"),
                             F.when(e % 3 == 1, "more").alias("l"))).alias("1"),
            F.array(F.struct(F.concat(F.lit("CVE-2021-"), _s(e % 50)).alias("1"), F.lit("vuln").alias("2"),
                             F.lit("2021-01-01").alias("3"), F.concat(F.lit("lev"), _s(e % 4)).alias("4"), F.lit("rce").alias("5"),
                             F.array(F.lit("winx"), F.lit("liny")).alias("6"), F.lit("poc").alias("7"),
                             F.array(F.struct(F.concat(F.lit("KB"), _s(e % 50)).alias("1"),
                                              F.lit("patch").alias("2"), F.lit("2021-02-02").alias("3"), F.lit("3").alias("4"),
                                              F.array(F.lit("lab")).alias("5"), F.array(F.concat(F.lit("CVE-2021-"), _s(e % 50))).alias("6"),
                                              F.lit("10").alias("7"), F.md5(F.concat(F.lit("k"), _s(e % 50))).alias("8"),
                                              F.lit("rules").alias("9"), F.lit("http://p/x").alias("a"))).alias("8"))).alias("2"),
            F.array(F.struct(ts.alias("1"), F.lit("").alias("2"), F.lit("IEP").alias("3"),
                             F.struct(F.lit("base").alias("1"), F.concat(F.lit("rule"), _s(e % 10)).alias("2"))
                              .alias("4"),
                             F.struct(F.concat(F.lit("unit"), _s(u % 3)).alias("1")).alias("5"),
                             F.when(e % 4 == 0, "源载荷").otherwise("目的载荷").alias("6"))).alias("3"),
        ).alias("i"))
    nfiles = F.when(etype == "virus_defend", u % 3 + 1).otherwise(F.lit(1))
    files = F.transform(F.sequence(F.lit(1), nfiles), lambda k: F.struct(
        F.md5(F.concat(F.lit("v"), _s(e), F.lit("-"), _s(k))).alias("md5"),
        F.concat(F.lit("C:\\data\\f"), _s(e), F.lit("_"), _s(k), F.lit(".doc")).alias("path"),
        _s(k * 100).alias("size"), v_name.alias("malname"), F.lit("").alias("mt"), F.lit("").alias("ct"),
        F.lit("1.0").alias("ver"), F.lit("").alias("digsig"), F.lit("quarantine").alias("option")))
    legacy = etype != "eventlog"
    return F.struct(
        etype.alias("type"), ts.alias("ts"),
        F.struct(F.concat(F.lit("agent-"), _s(u)).alias("uuid"), cip.alias("ip"),
                 F.concat(F.lit("srv"), _s(u % 4)).alias("server_uid"),
                 F.concat(F.lit("192.0.2."), _s(u % 4)).alias("server_ip"),
                 F.concat(F.lit("host"), _s(u)).alias("name"), F.lit("1").alias("group_id"),
                 F.lit("1").alias("company_id")).alias("client"),
        F.when(~legacy, data).alias("data"),
        F.when(etype.isin("virus_defend", "virus_detect"), files).alias("fileinfo"),
        F.when(etype == "proc_protect", _s(e % 9000)).alias("parent_process_id"),
        F.when(etype == "proc_protect", F.lit("C:\\Windows\\explorer.exe")).alias("parent_process_path"),
        F.when(etype == "proc_protect", md5).alias("parent_process_md5"),
        F.when(etype == "proc_protect", F.concat(F.lit("C:\\tmp\\child"), _s(e), F.lit(".exe")))
         .alias("child_process_path"),
        F.when(etype == "proc_protect", F.md5(F.concat(F.lit("c"), _s(e)))).alias("child_process_md5"),
        F.when(etype == "proc_protect", F.lit("-q")).alias("parameters"),
        F.when(etype == "active_protect", F.lit("HKLM\\Software\\Run")).alias("registry_path"),
        F.when(etype == "active_protect", F.concat(F.lit("k"), _s(e))).alias("registry_key"),
        F.when(etype == "active_protect", F.lit("v")).alias("registry_value"),
        F.when(legacy & ~etype.isin("virus_defend", "virus_detect"), v_name).alias("malname"),
    )


def endpoint_topic(events: DataFrame) -> DataFrame:
    """Kafka-shaped frame of endpoint-agent messages; every 97th value is not valid JSON
    (dead-letter path)."""
    e = F.col("event_id")
    val = F.to_json(endpoint_event_struct())
    return spread(events, "event_id").select(
        F.lit("iep_raw").alias("topic"),
        (e % 8).cast("int").alias("partition"),
        idiv(e, 8).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(e % 97 == 0, F.concat(F.lit("{broken "), _s(e))).otherwise(val).alias("value"),
    )
