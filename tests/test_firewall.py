"""Firewall decision tables (FIXTURES A1, SURVEY §2.13-D) and quirks Q3 / Q16."""

import json

from pyspark.sql import functions as F

from tidewatch.operators import firewall as fw

ZHENGUAN = ('<13>Jul 29 07:36:10 fw1 APP_POLICY: SerialNum=1 GenTime="2019-07-29 15:34:12" SrcIP=10.0.0.1 '
            'DstIP=10.0.0.2 ProtocolType=TCP SrcPort=1 DstPort=2 AppName=web Action=deny')
HILL_EVENT = ('<13>Jul 29 07:36:10 123456(root) abc Event@MGMT: Admin user logined, from 172.16.30.4:62434 '
              'to 172.16.100.100:22(TCP)')
HILL_SESSION = '<13>Jul 29 07:36:10 123456(root) abc Traffic@FLOW: SESSION: 10.1.1.1:1->10.2.2.2:80(TCP), interface x'
HILL_NAT = ('<13>Jul 29 07:36:10 123456(root) abc Traffic@FLOW: NAT: 10.1.1.1:1->10.2.2.2:80(TCP), '
            'snat to 198.51.100.9:4000, rule 1')
STAR_AV = ('<12>Jul 29 07:36:10 fw2 AV: SerialNum=9 GenTime="2019-07-29 15:34:12" NatType="Source NAT" '
           'SrcIP=10.0.0.5 SrcPort=1 Protocol=UDP X=1 X=2 bare Content="Session Backout"')
STAR_FILTER = STAR_AV.replace(" AV: ", " FILTER: ")
GAP = "<131>charset=[UTF-8] logType=[systemService] serviceName=[svc] result=[ok]"
OTHER = "<13>Jul 29 07:36:10 fw3 OSPF: neighbour up"
NO_PRI = "Jul 29 07:36:10 fw1 APP_POLICY: SerialNum=1 GenTime=\"2019-07-29 15:34:12\" SrcIP=10.0.0.1 a=b"
EMPTY_SIP = ZHENGUAN.replace("SrcIP=10.0.0.1", "SrcIP=")
NO_SIP = ZHENGUAN.replace("SrcIP=10.0.0.1 ", "")


def classify(spark, lines, raw=False):
    vals = [(i, ln if raw else json.dumps({"data": ln, "host": "192.0.2.1"})) for i, ln in enumerate(lines)]
    df = spark.createDataFrame(vals, "offset long, value string").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), "value")
    return fw.run(df)


def test_vendor_table(spark):
    lines = [ZHENGUAN, HILL_EVENT, HILL_SESSION, HILL_NAT, STAR_AV, STAR_FILTER, GAP, OTHER]
    r = {x["offset"]: x for x in classify(spark, lines).collect()}
    assert (r[0]["vendor"], r[0]["reason"], r[0]["black"]) == ("zhenguan", None, 1)
    assert r[1]["vendor"] is None and r[1]["reason"] == "unclassified"      # no TYPE word after @...:
    assert (r[2]["vendor"], r[2]["reason"]) == ("hillstone", "detail_no_match")
    assert (r[3]["vendor"], r[3]["reason"], r[3]["log_type"]) == ("hillstone", None, "NAT")
    assert (r[4]["vendor"], r[4]["reason"]) == ("star", None)
    assert (r[5]["vendor"], r[5]["reason"], r[5]["black"], r[5]["origin"]) == ("star", "type_filtered", 0, 1)
    assert (r[6]["vendor"], r[6]["reason"], r[6]["black"]) == ("gap", "detail_no_match", 0)
    assert r[7]["vendor"] is None


def test_rename_and_extras(spark):
    n = {x["log_type"]: x for x in fw.normalise(classify(spark, [ZHENGUAN, HILL_NAT, STAR_AV])).collect()}
    z = n["APP_POLICY"]
    assert (z["sip"], z["pro"], z["app"], z["gentime"], z["fire_type"]) == ("10.0.0.1", "TCP", "web", "", "4")
    h = n["NAT"]
    assert (h["sip"], h["dport"], h["pro"], h["aftertaddr"], h["aftertport"]) == ("10.1.1.1", "80", "TCP",
                                                                                 "198.51.100.9", "4000")
    s = n["AV"]
    assert (s["gentime"], s["nattype"], s["content"], s["pro"]) == ("2019-07-29 15:34:12", "Source NAT",
                                                                    "Session Backout", "UDP")
    assert s["extras"] == {"X": "2", "bare": "bare"}      # unmapped keys pass through, last duplicate wins
    assert (s["severity"], s["facility"]) == (12 & 7, (12 & 0x3F8) >> 3)


def test_quirks(spark):
    r = {x["offset"]: x for x in classify(spark, [EMPTY_SIP, NO_SIP, NO_PRI]).collect()}
    assert (r[0]["reason"], r[0]["black"]) == ("empty_srcip", 1)     # Q3: black counted before the reject
    assert r[1]["reason"] == "missing_srcip"                          # Q16: no exception, quarantined
    assert r[2]["reason"] == "bad_pri"


def test_raw_envelope(spark):
    r = classify(spark, [ZHENGUAN], raw=True).first()
    assert r["host"] is None and r["vendor"] == "zhenguan"


def test_accepted_plus_quarantined_is_input(spark):
    lines = [ZHENGUAN, HILL_EVENT, HILL_SESSION, HILL_NAT, STAR_AV, STAR_FILTER, GAP, OTHER, EMPTY_SIP, NO_SIP]
    c = classify(spark, lines)
    assert fw.normalise(c).count() + fw.quarantine(c).count() == len(lines)
