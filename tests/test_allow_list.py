"""FLT-12: the server allow-list holds for every inventory topic."""

from tidewatch.operators import inventory as INV
from tidewatch.plans.inventory_queries import _ctx
from tidewatch.sources import inventory as SI

from .conftest import SF001

ONE = ("192.0.2.1",)


def test_every_topic_keeps_only_allowed_servers(spark):
    lookup = _ctx(spark, SF001)
    topics = [(INV.software_reports, SI.software_info(spark, SF001), ()), (INV.hardware_messages, SI.hardware_info(spark, SF001), ())]
    topics += [(INV.host_messages, SI.host_activity(spark, SF001), (n,)) for n in ("ACD_host_ports", "ACD_host_service", "ACD_host_proc")]
    for read, topic, name in topics:
        some, every = read(topic, *name, lookup, allow=ONE), read(topic, *name, lookup)
        assert {r.server_ip for r in some.select("client.server_ip").distinct().collect()} == set(ONE)
        assert some.count() == every.where("client.server_ip = '192.0.2.1'").count() < every.count()
    rows = INV.ports(SI.host_activity(spark, SF001), lookup, allow=("none",))
    assert rows.count() == 0
