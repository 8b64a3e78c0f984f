"""Side-feed inputs derived from the driver tables (fixture C5): sandbox report lines,
SNMP trap messages, SNMP walk tables, drop-folder XML / capture files, API payloads and
heartbeat listings.  All are narrow projections (or explodes) of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .derive import table

S = lambda c: c.cast("string")


def sandbox_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``PTA-REPORT:`` lines, ``|``-separated: field 2 = md5 of the whole document text,
    field 7 = trust (1 = black, by ``n_chars`` parity), field 10 = finished."""
    d = table(spark, sf_dir, "documents")
    fields = [F.lit("r"), S(F.col("doc_id")), F.md5(F.col("text")), F.col("lang"), F.col("source"), S(F.col("n_chars")),
              F.lit("x"), F.when(F.col("n_chars") % 2 == 0, "1").otherwise("0"), F.lit("y"), F.lit("z"),
              F.when(F.col("doc_id") % 4 != 0, "1").otherwise("0")]
    return d.select(F.col("doc_id").alias("key"), F.concat(F.lit("PTA-REPORT:"), F.concat_ws("|", *fields)).alias("value"))


def trap_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trap per (supplier, interface 1..3), published as ``{"message": text}`` where the
    text is: host line, transport line, uptime line, trap-OID line, varbind lines."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ex = s.select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("i"))
    i = F.col("i")
    down = (k + i) % 2 == 0
    name = F.when(k % 5 == 0, F.lit("uplink-7")).otherwise(F.concat(F.lit("eth"), S(i)))
    text = F.concat_ws("\n",
                       F.concat(F.lit("sw"), S(k)),
                       F.concat(F.lit("UDP: [192.0.2."), S(k % 4), F.lit("]:39561->[198.51.100.1]:162")),
                       F.concat(F.lit("DISMAN-EVENT-MIB::sysUpTimeInstance 12:17:36:"), S(k % 60)),
                       F.concat(F.lit("SNMPv2-MIB::snmpTrapOID.0 IF-MIB::"), F.when(down, "linkDown").otherwise("linkUp")),
                       F.concat(F.lit("IF-MIB::ifDescr."), S(i), F.lit(" "), name),
                       F.concat(F.lit("IF-MIB::ifOperStatus."), S(i), F.lit(" "), F.when(down, "down").otherwise("up")))
    return ex.select((k * 10 + i).alias("key"), F.to_json(F.struct(text.alias("message"))).alias("value"))


def snmp_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk results as ``(host, table_oid, idx, column, value)``: interfaces, addresses,
    storage, processor load and system rows per supplier (three interfaces each)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    host = F.concat(F.lit("sw"), S(k))
    if_t, ip_t, st_t = "1.3.6.1.2.1.2.2.1", "1.3.6.1.2.1.4.20.1", "1.3.6.1.2.1.25.2.3.1"

    def row(t: str, idx: Column, col: str, val: Column) -> Column:
        return F.struct(F.lit(t).alias("table_oid"), S(idx).alias("idx"), F.lit(col).alias("column"),
                        S(val).alias("value"))

    rows = []
    for i in (1, 2, 3):
        ii = F.lit(i)
        rows += [row(if_t, ii, "1", ii), row(if_t, ii, "2", F.concat(F.lit("eth"), ii.cast("string"))),
                 row(if_t, ii, "3", F.lit(6)), row(if_t, ii, "4", F.lit(1500)),
                 row(if_t, ii, "5", F.lit(1000000000).cast("long") * i),
                 row(if_t, ii, "6", F.concat(F.lit("0x00163e"), F.lpad(F.hex(k * 4 + i), 6, "0")))]
    for i in (1, 2):
        ip = F.concat(F.lit("10.200."), S(k % 256), F.lit("."), F.lit(str(i)))
        rows += [row(ip_t, ip, "1", ip), row(ip_t, ip, "2", F.lit(i)), row(ip_t, ip, "3", F.lit("255.255.255.0"))]
    for j, (typ, descr) in enumerate([("1.3.6.1.2.1.25.2.1.2", "Physical memory"),
                                      ("1.3.6.1.2.1.25.2.1.4", "/"),
                                      ("1.3.6.1.2.1.25.2.1.99", "0x2f64617461")], start=1):
        jj = F.lit(j)
        rows += [row(st_t, jj, "1", jj), row(st_t, jj, "2", F.lit(typ)), row(st_t, jj, "3", F.lit(descr)),
                 row(st_t, jj, "4", F.lit(4096)), row(st_t, jj, "5", F.lit(1000) * (k + j)),
                 row(st_t, jj, "6", F.lit(10) * (k + j))]
    for c in (1, 2):
        rows.append(row("1.3.6.1.2.1.25.3.3.1", F.lit(c), "2", (k * c) % 100))
    rows += [row("1.3.6.1.2.1.1", F.lit(0), "1", F.when(k % 3 == 0, F.lit("Hardware: x86 Windows Version 6.1"))
                 .otherwise(F.lit("Linux sw 4.19.0"))),
             row("1.3.6.1.2.1.1", F.lit(0), "5", host)]
    return s.select(host.alias("host"), F.explode(F.array(*rows)).alias("r")).select("host", "r.*")


def drop_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop-folder files as ``(path, content)``: per page an XML metadata file and, when
    ``page_id % 3 <> 0``, its capture file with the same stem."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    stem = F.concat(F.lit("drop/"), S(k % 10), F.lit("/cap"), S(k))
    xml = F.concat(F.lit("<task><FILENAME>cap"), S(k), F.lit(".pcap</FILENAME><LINENO>"), S(k % 100),
                   F.lit("</LINENO><TASKID>t"), S(k % 7), F.lit("</TASKID><GROUPID>g"), S(k % 3),
                   F.lit("</GROUPID><DANWEI>unit"), S(k % 5), F.lit("</DANWEI><RULEID>r"), S(k % 11),
                   F.lit("</RULEID><TASKTIME>2024-01-01 00:00:00</TASKTIME></task>"))
    files = F.array(F.struct(F.concat(stem, F.lit(".xml")).alias("path"), xml.alias("content")),
                    F.when(k % 3 != 0, F.struct(F.concat(stem, F.lit(".pcap")).alias("path"),
                                                F.lit("pcap-bytes").alias("content"))))
    return p.select(F.explode(F.filter(files, lambda f: f.isNotNull())).alias("f")).select("f.*")


def api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API bodies ``{"data": [line, ...]}``: one per conversation turn, the lines of the
    whole turn text."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.to_json(F.struct(F.split(F.col("text"), "\n").alias("data"))).alias("body"))
