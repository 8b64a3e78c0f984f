"""Invariants and property tests of the address helpers."""

import ipaddress

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import net as N
from tidewatch.operators import firewall as fw
from tidewatch.operators import sensor as S
from tidewatch.plans import registry
from tidewatch.sources import derive

from .conftest import SF001


def test_counters_sum_to_rows(spark):
    ev = derive.table(spark, SF001, "events")
    n = ev.count()
    c = fw.run(derive.firewall_topic(ev))
    tot = fw.firewall_totals(c).filter("day IS NULL").first()
    assert tot["origin_count"] == n
    assert fw.normalise(c).count() + fw.quarantine(c).count() == n          # accepted + quarantined = input
    daily = S.daily_counts(S.decode_batches(derive.sensor_topic(ev)))
    assert daily.agg(F.sum("origin_count")).first()[0] == n


def test_two_runs_are_identical(spark):
    registry.load_all()
    for name in ("fw_normalised", "inv_asset_snapshot", "sensor_new_techniques"):
        a = registry.QUERIES[name](spark, SF001)
        b = registry.QUERIES[name](spark, SF001)
        cols = a.columns
        ha = a.select(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("n")).first()
        hb = b.select(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("n")).first()
        assert ha == hb, name


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2 ** 32 - 1), min_size=1, max_size=20))
def test_ip_to_long_property(spark, values):
    ips = [(str(ipaddress.IPv4Address(v)),) for v in values]
    got = [r[0] for r in spark.createDataFrame(ips, "ip string").select(N.ip_to_long(F.col("ip"))).collect()]
    assert got == values


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2 ** 32 - 1), min_size=1, max_size=20))
def test_private_property(spark, values):
    ips = [str(ipaddress.IPv4Address(v)) for v in values]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in ips], "ip string")
           .select(N.is_private(F.col("ip"))).collect()]
    nets = [ipaddress.ip_network(n) for n in ("127.0.0.0/8", "192.168.0.0/16", "172.16.0.0/12", "10.0.0.0/8")]
    want = [any(ipaddress.IPv4Address(x) in n for n in nets) for x in ips]
    assert got == want
