"""Sensor decision tables on hand-written alerts."""

import json

from pyspark.sql import functions as F

from tidewatch.operators import sensor as S

HIT = {"malname": "trojan[suspicious-login]/a", "virus_type": "t", "virus_family": "f", "virus_platform": "w",
       "virus_behaviors": "b", "author": "a", "rid": "r1"}


def alert(**kw):
    base = {"id": "x", "dev": "dev1", "type": "alert", "is_malicious": True, "alert": False, "label": "",
            "ts": {"start": "2024-01-01 00:00:00"}, "proto": ["TCP"],
            "src": {"ip": "10.0.0.1", "port": "1"}, "dst": {"ip": "203.0.113.9", "port": "2"}}
    base.update(kw)
    return base


def run(spark, alerts):
    rows = [(i, json.dumps({"data": [a]})) for i, a in enumerate(alerts)]
    df = spark.createDataFrame(rows, "offset long, value string").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), "value")
    return {r["offset"]: r for r in S.standardise(df).collect()}


def test_scene_type_and_orientation(spark):
    r = run(spark, [
        alert(proto=["SMTP"], d={"file": [dict(HIT, md5="m1")]}),                        # 0 mail, SMTP -> src
        alert(proto=["IMAP"], d={"file": [dict(HIT, md5="m1")]}),                        # 1 IMAP -> dst
        alert(avlist=[{"victim": {"name": "10.0.0.1"}}], d={"url": [HIT]}),              # 2 avlist victim = src
        alert(d={"sengine": [dict(HIT, msg="Huawei x", related={"attacker": ["203.0.113.9"]})]}),  # 3 attacker = dst
        alert(d={"sengine": [dict(HIT, msg="SQL inj", classtype="web-application-attack", related={})]}),  # 4
        alert(),                                                                          # 5 no d
    ])
    assert (r[0]["scene"], r[0]["threat_flag"], r[0]["keyword"], r[0]["swapped"]) == ("src", "md5", "利用受感染主机", False)
    assert (r[1]["scene"], r[1]["keyword"], r[1]["swapped"]) == ("dst", "发送恶意邮件", True)
    assert (r[2]["swapped"], r[2]["threat_flag"], r[2]["src"]["ip"]) == (True, "c2", "203.0.113.9")
    assert (r[3]["swapped"], r[3]["keyword"], r[3]["first_type"], r[3]["second_type"]) == (
        True, "利用固件漏洞", "网络攻击事件", "漏洞攻击事件")
    assert (r[4]["swapped"], r[4]["keyword"]) == (False, "注入数据库命令")   # no attacker, scene src
    assert r[5]["threat_flag"] is None and r[5]["keyword"] == ""


def test_gating(spark):
    r = run(spark, [alert(type="heartbeat"), alert(is_malicious=False, alert=False), alert(alert=True)])
    assert list(r) == [2]


def test_payload_order_labels_and_file_join(spark):
    info = [{"md5": "m1", "name": "a%20b.exe", "bytes": "10", "type": "PE", "direction": "up"}]
    r = run(spark, [
        alert(label="跨境通讯", d={"url": [HIT], "sengine": [dict(HIT, malname="worm/x", related={})],
                                  "domain": [HIT]}),
        alert(file=info, d={"file": [dict(HIT, md5="m1"), dict(HIT, md5="zz")]}),   # unmatched hit dropped
        alert(d={"file": [dict(HIT, md5="zz")]}),                                    # no info: bare payload
        alert(file=info),                                                            # file-only payload
    ])
    assert [p["engine"] for p in r[0]["payloads"]] == ["C2", "sengine", "C2"]
    assert r[0]["xw_labels"] == ["user_defined:跨境通讯", "C2引擎:C2通信", "sengine:蠕虫程序", "C2引擎:C2通信"]
    p1 = r[1]["payloads"]
    assert len(p1) == 1 and p1[0]["o_filename"] == "a b.exe" and p1[0]["loader_behavior_label"] == ["AVL引擎:可疑登录"]
    assert r[1]["xw_labels"] == ["AVL引擎:上传文件"]
    assert len(r[2]["payloads"]) == 1 and r[2]["payloads"][0]["size"] is None
    assert [p["engine"] for p in r[3]["payloads"]] == ["file-only"] and r[3]["search_v_name"] is None


def test_carriers(spark):
    r = run(spark, [alert(dns={"msg": {"msg_type": "query", "record": [{"Rtype": "A", "data": "1.2.3.4"}]}},
                          domain=["evil.example"]),
                    alert(http={"request": {"method": "GET", "header": {"host": "h", "uri": "/u",
                                                                        "other": [{"key": "Accept", "value": "1"},
                                                                                  {"key": "", "value": ""}]}}},
                          msg={"upload": {"md5": ""}}, url=["http://h:81/p%20q"])])
    # no detection at all: scene is dst, so the alert is swapped and a dns query's names
    # belong to the (new) source side
    assert (r[0]["swapped"], r[0]["protocol"], r[0]["src_domain"], r[0]["dst_domain"]) == (
        True, "dns", "evil.example", "")
    assert r[1]["protocol"] == "smb"                      # last present carrier wins
    assert r[1]["http_info"]["URL"] == "h/u" and r[1]["http_info"]["request_headers"] == {"Accept": "1"}
    assert r[1]["src_url"] == "http://h:81/p q" and r[1]["src_domain"] == "h:81"   # http x swapped -> source
