"""Inventory messages (eight topics, fixture C4) derived from the star schema.

Every builder returns a Kafka-shaped frame ``(topic, partition, offset, timestamp, value)``
whose ``value`` is the JSON message the endpoint servers publish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .derive import _pick, idiv, table, user_ip

S = lambda c: c.cast("string")
OS_VERSIONS = ["Windows 10 Pro", "Ubuntu 18.04.3 LTS", "CentOS Linux 7.6", "other"]


def _frame(df: DataFrame, topic: str, key: Column, ts: Column, msg: Column) -> DataFrame:
    return df.select(F.lit(topic).alias("topic"), (key % 8).cast("int").alias("partition"),
                     key.cast("long").alias("offset"), ts.cast("timestamp").alias("timestamp"),
                     F.to_json(msg).alias("value"))


def client(k: Column) -> Column:
    return F.struct(F.concat(F.lit("agent-"), S(k)).alias("uuid"), user_ip(k).alias("ip"),
                    F.concat(F.lit("srv"), S(k % 4)).alias("server_uid"),
                    F.concat(F.lit("192.0.2."), S(k % 4)).alias("server_ip"))


def client_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACD_client_info: one report per order (the customer's agent reporting its state)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_custkey")
    msg = F.struct(
        F.concat(F.lit("192.0.2."), S(k % 4)).alias("server_ip"),
        F.concat(F.lit("srv"), S(k % 4)).alias("server_uid"),
        F.concat(F.lit("agent-"), S(k)).alias("uuid"),
        F.concat(F.lit("d"), S(k % 25)).alias("group_id"),
        _pick(F.col("o_orderkey") % 4, OS_VERSIONS).alias("sysver"),
        F.when(F.col("o_orderstatus") == "O", "install").otherwise("uninstall").alias("status"),
        F.array(F.struct(user_ip(k).alias("ip"), F.lpad(F.lower(F.hex(k)), 12, "0").alias("mac"))).alias("address"))
    return _frame(o, "ACD_client_info", F.col("o_orderkey"), F.col("o_orderdate"), msg)


def software_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACD_software_info: one report per order, the list of all its lines; names are garbled
    ('??') when ``l_partkey % 97 = 0``."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    p = F.col("l_partkey")
    name = F.when(p % 97 == 0, F.concat(F.lit("pkg??"), S(p))).otherwise(F.concat(F.lit("pkg"), S(p)))
    package = F.struct(
        F.concat(F.lit("C:\\Program Files\\pkg"), S(p)).alias("path"), S(F.col("l_quantity")).alias("ver"),
        name.alias("name"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("instime"),
        F.lit("vendor").alias("author"))
    per = j.groupBy("o_orderkey", "o_custkey", "o_orderdate").agg(
        F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("pos"), package.alias("w")))).alias("lines"))
    msg = F.struct(client(F.col("o_custkey")).alias("client"), F.transform("lines", lambda x: x["w"]).alias("softwareinfo"))
    return _frame(per, "ACD_software_info", F.col("o_orderkey"), F.col("o_orderdate"), msg)


def hardware_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACD_hardware_info: one report per part from the agent of that number; ``data`` is the
    nine-slot array of JSON documents (cpu, board, system, graphics[], memory[], net[], disk[],
    drive[], sound[]).  0 to 3 memory sticks, of which the first two share a maker; no
    mainboard when ``p_partkey % 10 = 7``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    gb = F.col("p_size").cast("long") * 1073741824
    js = F.to_json
    stick = lambda i, maker: F.struct(
        maker.alias("Manufacturer"), F.concat(F.lit(f"P{i}-"), S(k)).alias("PartNumber"), F.concat(F.lit(f"M{i}-"), S(k)).alias("SerialNumber"),
        F.lit("2400").alias("Speed"), S(gb).alias("Capacity"))
    slots = F.array(
        js(F.struct(F.col("p_brand").alias("Name"), (k % 8 + 1).alias("linenum"), (k % 4 + 1).alias("NumberOfCores"),
                    F.lit("SOCKET 0").alias("SocketDesignation"))),
        F.when(k % 10 != 7, js(F.struct(
            F.col("p_type").alias("Manufacturer"), F.when(k % 9 == 0, "None").otherwise(F.concat(F.lit("SN"), S(k))).alias("SerialNumber"),
            F.when(k % 4 == 0, "None").otherwise(S(k % 4)).alias("Version"), F.concat(F.lit("v"), S(k % 5)).alias("BIOSVersion"),
            F.when(k % 6 == 0, "").otherwise("2020-01-02").alias("BIOSReleaseDate")))),
        js(F.struct(F.lit("x64").alias("arch"))),
        js(F.array(F.struct(F.concat(F.lit("gpu"), S(k % 3)).alias("Caption"), S(k % 8).alias("AdapterRAM"), F.lit("1.0").alias("DriverVersion")))),
        js(F.slice(F.array(stick(0, F.col("p_type")), stick(1, F.col("p_type")), stick(2, F.col("p_brand"))), 1, (k % 4).cast("int"))),
        js(F.array(F.struct(F.col("p_type").alias("Manufacturer"), F.concat(F.lit("eth"), S(k % 2)).alias("Name"),
                            F.lpad(F.hex(k), 12, "0").alias("MACAddress"), F.lit("LAN").alias("NetConnectionID"),
                            F.when(k % 2 == 0, "True").otherwise("False").alias("NetEnabled")))),
        js(F.array(F.struct(F.concat(F.lit("disk"), S(k % 2)).alias("Caption"), F.lit("F1").alias("FirmwareRevision"),
                            F.when(k % 13 == 0, F.lit("unknown")).otherwise(S(gb)).alias("Size")))),
        js(F.array(*[F.struct(F.lit("dvd").alias("Caption"), F.lit("DVD").alias("MediaType"), F.lit(d).alias("Drive")) for d in ("E:", "F:")])),
        js(F.array(F.struct(F.lit("maker").alias("Manufacturer"), F.lit("snd").alias("Caption")))),
    )
    msg = F.struct(client(k).alias("client"), slots.alias("data"))
    return _frame(p, "ACD_hardware_info", k, F.lit("2024-01-01").cast("timestamp"), msg)


def host_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACD_host_ports / ACD_host_service / ACD_host_proc / ACD_loophole_detect reports from
    ``events`` (one per event, the topic chosen by ``event_id % 4``)."""
    ev = table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    sport = F.when(e % 10 == 0, F.lit(-1)).otherwise(F.lit(1024) + e % 1000)
    topic = _pick(e % 4, ["ACD_host_ports", "ACD_host_service", "ACD_host_proc", "ACD_loophole_detect"])
    msg = F.struct(
        client(u).alias("client"),
        F.when(e % 4 == 0, F.array(F.struct(user_ip(u).alias("sip"), F.lit("198.51.100.7").alias("dip"),
                                            F.lit("TCP").alias("proto"), F.concat(F.lit("p"), S(e % 20)).alias("proc"),
                                            sport.alias("sport"), F.lit(443).alias("dport")))).alias("portinfos"),
        F.when(e % 4 == 1, F.array(F.struct(
            F.lit("running").alias("status"), F.concat(F.lit("svc"), S(e % 30)).alias("service"),
            F.concat(F.lit("Service "), S(e % 30)).alias("name"),
            F.concat(F.lit("\"C:\\svc\\s"), S(e % 30), F.lit(".exe\" -k netsvcs")).alias("path"),
            F.lit("auto").alias("class"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("systime")))).alias("serviceinfo"),
        F.when(e % 4 == 2, F.array(F.struct(
            F.lit("alive").alias("status"), S(e % 5000).alias("pid"), F.concat(F.lit("proc"), S(e % 40)).alias("proc"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("systime")))).alias("porcinfos"),
        F.when(e % 4 == 3, F.concat(F.lit("CVE-2022-"), S(e % 200))).alias("vuln_id"),
    )
    return ev.select(topic.alias("topic"), (e % 8).cast("int").alias("partition"), idiv(e, 8).alias("offset"),
                     F.col("ts").cast("timestamp").alias("timestamp"), F.to_json(msg).alias("value"))


def organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACD_organization: per nation, the company (its region, parent '0') and the
    department (the nation) as reported by one endpoint server."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    comp = F.struct(F.lit("0").alias("pid"), F.concat(F.lit("c"), S(F.col("n_regionkey"))).alias("id"),
                    F.concat(F.lit("company"), S(F.col("n_regionkey"))).alias("cname"),
                    F.array(F.struct(F.concat(F.lit("c"), S(F.col("n_regionkey"))).alias("pid"),
                                     F.concat(F.lit("d"), S(k)).alias("gid"), F.col("n_name").alias("gname")))
                    .alias("group"))
    msg = F.struct(F.concat(F.lit("192.0.2."), S(k % 4)).alias("server_ip"),
                   F.concat(F.lit("srv"), S(k % 4)).alias("server_uid"), F.array(comp).alias("org"))
    return _frame(n, "ACD_organization", k, F.lit("2024-01-01").cast("timestamp"), msg)
