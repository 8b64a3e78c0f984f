"""Scalar functions on hand-written rows (SCL-*, FLT-16/17/20)."""

from pyspark.sql import functions as F

from tidewatch.functions import net as N
from tidewatch.functions import text as T


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_kv_tokens_last_wins_and_bare_token(spark):
    m = one(spark, T.kv_tokens(F.col("x")), 'a=1 b="q r" a=2 bare c=x=y')
    assert m["a"] == "2"                 # last duplicate wins
    assert m["bare"] == "bare"           # a token without '=' maps to itself
    assert m["b"] == '"q'                # quotes kept, split on single spaces
    assert m["c"] == "x=y"               # split on the first '=' only


def test_ip_to_long_and_malformed(spark):
    assert one(spark, N.ip_to_long(F.col("x")), "10.0.1.2") == 10 * 2 ** 24 + 256 + 2
    assert one(spark, N.ip_to_long(F.col("x")), "255.255.255.255") == 2 ** 32 - 1
    assert one(spark, N.ip_to_long(F.col("x")), "1.2.3") == 0   # wrong number of parts -> 0


def test_mask_bounds(spark):
    lo, hi = N.mask_bounds(F.col("x"), F.lit("255.255.0.0"))
    r = spark.createDataFrame([("10.1.7.9",)], "x string").select(lo.alias("lo"), hi.alias("hi")).first()
    assert (r["lo"], r["hi"]) == (167837696, 167837696 + 65535)


def test_private_and_company_range(spark):
    for ip, want in [("127.0.0.1", True), ("192.168.3.4", True), ("172.31.0.1", True), ("172.32.0.1", False),
                     ("10.9.9.9", True), ("8.8.8.8", False), ("", False), ("300.1.1.1", False)]:
        assert one(spark, N.is_private(F.col("x")), ip) is want, ip
    assert one(spark, N.in_range(F.col("x"), "198.51.100.0", "198.51.100.255"), "198.51.100.255") is True


def test_validation(spark):
    assert one(spark, N.is_valid_ipv4(F.col("x")), "192.0.2.10") is True
    assert one(spark, N.is_valid_ipv4(F.col("x")), "192.0.2.256") is False
    assert one(spark, N.is_dash_mac(F.col("x")), "00-1A-2B-3C-4D-5E") is True


def test_mac_normalise(spark):
    assert one(spark, N.normalise_mac(F.col("x")), "001a2b3c4d5e") == "00-1A-2B-3C-4D-5E"
    assert one(spark, N.normalise_mac(F.col("x")), "a2b3c") == "A-2B-3C"


def test_percent_decode_keeps_plus(spark):
    assert one(spark, T.percent_decode(F.col("x")), "a%20b+c") == "a b+c"
    assert one(spark, T.percent_decode(F.col("x")), "bad%zz") == "bad%zz"


def test_url_authority(spark):
    assert one(spark, T.url_authority(F.col("x")), "http://u:p@h.example:81/a b?q") == "u:p@h.example:81"
    assert one(spark, T.url_authority(F.col("x")), "no-scheme/path") == ""


def test_malware_name_parts(spark):
    r = spark.createDataFrame([("Trojan[Spy]/Win32.x",)], "x string").select(
        T.malware_category(F.col("x")).alias("c"), T.malware_behaviour(F.col("x")).alias("b")).first()
    assert (r["c"], r["b"]) == ("Trojan", "Spy")


def test_paths(spark):
    cmd = r'run C:\a\b.exe --x D:\y.txt /tmp/z'
    # a segment runs on over spaces up to a character that no path has; a Unix path must lead
    assert one(spark, T.windows_paths(F.col("x")), cmd) == ["C:\\a\\b.exe --x D:\\y.txt "]
    assert one(spark, T.unix_paths(F.col("x")), cmd) == []
    assert one(spark, T.unix_paths(F.col("x")), "/usr/bin/p1 -x /tmp/u") == ["/usr/bin/p1"]
    assert one(spark, T.command_paths(F.col("x"), F.lit("Windows 10")), r"C:\a\b.exe|x") == [r"C:\a\b.exe"]
    assert one(spark, T.file_name_from_path(F.col("x")), "C:\\a\\b.exe") == "b.exe"


def test_bytes_service_path_hex(spark):
    assert one(spark, T.bytes_to_g(F.col("x")), str(5 * 2 ** 30 + 7)) == "5G"
    assert one(spark, T.bytes_to_g(F.col("x")), "unknown") == "unknown"
    assert one(spark, T.service_path(F.col("x")), '"C:\\s\\a.exe" -k net') == "C:\\s\\a.exe"
    assert one(spark, T.hex_to_text(F.col("x")), "0x2f64617461") == "/data"
    assert one(spark, T.hex_to_text(F.col("x")), "plain") == "plain"


def test_header_map_stops_at_empty(spark):
    df = spark.createDataFrame([([("Host", "1"), ("", ""), ("X-Own", "4"), ("Accept", "2"), None, ("Cookie", "3")],)], "x array<struct<key:string,value:string>>")
    assert df.select(T.header_map(F.col("x")).alias("m")).first()["m"] == {"Host": "1", "Accept": "2"}


def test_cidr_cover_is_exact(spark):
    import random

    from tidewatch.functions import net as N

    rng = random.Random(2)
    rows = [(a, a + rng.choice([0, 1, 5, 255, 256, 70000, 3])) for a in (rng.randrange(0, 2**32 - 80000) for _ in range(60))]
    rows += [(0, 2**32 - 1), (7, 7), (0, 0), (2**32 - 1, 2**32 - 1)]
    df = spark.createDataFrame(rows, "lo bigint, hi bigint")
    for r in df.select("lo", "hi", N.cidr_cover("lo", "hi").alias("c")).collect():
        spans = sorted((b.block << b.bits, (b.block + 1) << b.bits) for b in r.c)
        assert spans[0][0] == r.lo and spans[-1][1] == r.hi + 1
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert len(spans) <= 64


def test_os_group(spark):
    for v, want in [("Windows 10 Pro", "Windows"), ("Ubuntu 18.04.3 LTS", "Ubuntu 18.04"),
                    ("CentOS Linux 7.6", "CentOS 7"), ("other", None)]:
        assert one(spark, T.os_group(F.col("x")), v) == want


def test_cve_and_tactics(spark):
    df = spark.createDataFrame([(["cve,CVE-1", "url,x", "cve,CVE-2"], "A, B,C")], "r array<string>, t string")
    r = df.select(T.cve_ids(F.col("r")).alias("c"), T.split_trim_first_space(F.col("t")).alias("t")).first()
    assert r["c"] == ["CVE-1", "CVE-2"] and r["t"] == ["A", "B", "C"]


def test_truthy(spark):
    for v, want in [(None, False), ("", False), ("0", False), ("false", False), ("x", True), ("1", True)]:
        assert one(spark, T.truthy(F.col("x")), v) is want


def test_syslog_line(spark):
    r = one(spark, T.parse_syslog_line(F.col("x")), "Oct  9 22:33:20 host1 app: [12][WARN] disk full")
    assert (r["PRI"], r["HEADER"], r["PID"], r["OWNER"], r["MSG"]) == ("12", "Oct  9 22:33:20 host1", "[12]", "app",
                                                                       "disk full")
    assert one(spark, T.parse_syslog_line(F.col("x")), "not a syslog line") is None


def test_group_separator_in_a_line_shifts_nothing(spark):
    from tidewatch.functions import text as T

    pattern = r"(?P<a>\w+)=(?P<b>.*?) (?P<c>\w+)"
    df = spark.createDataFrame([("k=x\u0001y z rest",)], "s string")
    assert df.select(T.extract_groups(F.col("s"), pattern, ["a", "b", "c"]).alias("g")).first().g == ["k", "xy", "z"]
