"""The nested standard event of network sensors (SNK-02, DOM-05 .. DOM-19, JOIN-04, JOIN-10 .. JOIN-12).

Three things come from joins and are made first: the asset details of both endpoints, and the
ATT&CK labels with their dictionary numbers, as one array for each alert.  Everything else is local to the
alert and bound to the declared template.  Fixed against the source: the longitude isn't
overwritten, an upload holds the upload.
"""

from __future__ import annotations

import functools
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .. import standard_event as SE
from ..functions import net as N
from ..functions import text as T
from ..functions.template import Each, build
from . import sensor as S

TEMPLATE = SE.template(SE.SENSOR_PRODUCT)
_AT = ("topic", "partition", "offset", "pos")


def with_assets(alerts: DataFrame, details: DataFrame) -> DataFrame:
    """Adds ``src_asset`` and ``dst_asset`` (asset_id, os, unit, detail; null if unknown).  Only private
    addresses are looked up, the destination only if the reply carried something (FLT-18)."""
    answered = (F.coalesce(F.col("s2c.pkts"), F.lit(0)) != 0) | (F.coalesce(F.col("s2c.bytes"), F.lit(0)) != 0)
    out = alerts
    # a side without a lookup gets a key that no address has, its own, so that all of them don't meet in one task
    own = F.concat(F.lit("-"), F.concat_ws("/", *_AT))
    for side, wanted in (("src", F.lit(True)), ("dst", answered)):
        found = details.select(F.col("ip_addr").alias(f"_{side}_ip"), F.struct("asset_id", F.col("os_ver").alias("os"), "unit", "detail").alias(f"{side}_asset"))
        out = out.withColumn(f"_{side}_key", F.when(wanted & N.is_private(F.col(f"{side}.ip")), F.col(f"{side}.ip")).otherwise(own))
        out = out.join(found, out[f"_{side}_key"] == found[f"_{side}_ip"], "left").drop(f"_{side}_key", f"_{side}_ip")
    return out


def with_attack_labels(alerts: DataFrame, techniques: DataFrame) -> DataFrame:
    """Adds ``attack_label``: the alert's tactics in order with the technique's number of the dictionary.
    Only alerts with such hits travel, as (place in the topic, tactic, technique)."""
    key = F.concat_ws("/", *_AT)
    labels = S.attack_labels(alerts.select(key.alias("id"), "d"), techniques)
    entry = F.struct("hit_pos", "attck_pos", "tactic_pos", "tactic", "technique", "tactic_number", F.col("technique_number").cast("string").alias("technique_number"))
    each = labels.groupBy(F.col("id").alias("_at")).agg(F.array_sort(F.collect_list(entry)).alias("attack_label"))
    # every alert has its place as the key: nulls for those without such a hit would all meet in one task
    out = alerts.withColumn("_key", key)
    return out.join(each, out["_key"] == each["_at"], "left").drop("_key", "_at")


def _list(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit("")) != "", F.array(x)).otherwise(F.array().cast("array<string>"))


def _endpoint(side: str) -> dict[str, Any]:
    e, asset = F.col(side), F.col(f"{side}_asset")
    detail = asset["detail"]
    return {
        "ip_info.ip": e["ip"], "ip_info.port": e["port"], "ip_info.mac": e["mac"], "ip_info.ip_country": e["country"], "ip_info.ip_city": e["city"],
        "ip_info.ip_region": e["region"], "ip_info.isp": e["isp"], "ip_info.ip_longitude": e["location"]["lon"], "ip_info.ip_latitude": e["location"]["lat"],
        "ip_info.ip_cp": _unit(side), "domain_info.domain": F.col(f"{side}_domain"), "url": F.col(f"{side}_url"), "label": _list(F.col("label")),
        "detect.detect_time": F.col("ts.start"), "detect.detect_pro_id": F.col("dev"),
        "asset_detail.asset_id": asset["asset_id"], "asset_detail.os": asset["os"], "asset_detail.unit": asset["unit"],
        "asset_detail.ip_group": Each(detail["ip_group"], lambda x: {"ip": x["ip"], "mac": x["mac"]}, or_default=True),
        "asset_detail.network_struct": _list(detail["network"]), "asset_detail.type": detail["type"], "asset_detail.asset_level": detail["asset_level"],
        "asset_detail.people.user": detail["user"], "asset_detail.people.manager": detail["manager"], "asset_detail.applications": detail["applications"]}


def _unit(side: str) -> Column:
    """DOM-12: of a known asset, the database's unit, else the sensor's."""
    asset = F.col(f"{side}_asset")
    return F.when(asset["asset_id"].isNotNull(), S.unit_precedence(asset["unit"], F.col(f"{side}.unit")))


def _transfer(prefix: str, body: Column, direction: str, hashes: str) -> dict[str, Column]:
    return {f"{prefix}.bytes": body["bytes"], f"{prefix}.{direction}": body["direction"], f"{prefix}.file_name": body["fn"], f"{prefix}.file_type": body["ft"],
            f"{prefix}.{hashes}.md5": body["md5"]}


def _carrier() -> dict[str, Any]:
    http, dns, mail = F.col("http"), F.col("dns_info"), F.col("email_info")
    sent, got = F.col("http_info.request_headers"), F.col("http_info.response_headers")
    names = [n for n in SE.HEADERS if n in T.CARRIER_HEADERS]
    data = {
        "dns_info.message_type": dns["message_type"], "dns_info.record.record_type": dns["record_type"], "dns_info.record.pro_info": dns["pro_info"],
        "dns_info.record.alias": dns["alias"], "dns_info.record.return_data": dns["return_data"],
        **{f"email_info.{k}": mail[k] for k in ("from", "to", "sender", "sub")}, "email_info.content.text": mail["text"],
        "email_info.file": Each(mail["file"], lambda f: {"file_name": f["file_name"], "file_format": f["file_format"], "filehash.md5": f["md5"]}),
        "http_info.request.header.method": F.col("http_info.method"), "http_info.request.header.URL": F.col("http_info.URL"),
        **{f"http_info.request.header.{n}": F.try_element_at(sent, F.lit(n)) for n in names},
        **{f"http_info.response.header.{n}": F.try_element_at(got, F.lit(n)) for n in names},
        "http_info.request.header.version": F.try_element_at(sent, F.lit("Version")), "http_info.response.header.version": F.try_element_at(got, F.lit("Version")),
        **_transfer("http_info.request.body", http["request"]["body"], "direction", "file_hash"),
        **_transfer("http_info.response.body", http["response"]["body"], "direction", "filehash")}
    for name, source in (("ftp_info", F.col("ftp")), ("smb_info", F.col("msg"))):
        for way in ("upload", "download"):
            data |= _transfer(f"{name}.{way}", source[way], "direct", "file_hash")
    return {"protocol": F.col("protocol")} | {f"info.data_info.{k}": c for k, c in data.items()}


def bindings() -> dict[str, Any]:
    """Paths of the template and what they hold, over a standardised alert with assets and attack labels."""
    when_, dev = F.col("ts.start"), F.col("dev")
    blank = F.struct(F.lit("").alias("vulne_name"), F.lit("").alias("open_time"), F.lit("").alias("vulne_level"), F.lit("").alias("vulne_type"),
                     F.array().cast("array<string>").alias("for_products"))
    hole = lambda cve: F.struct(cve.alias("vulne_id"), *(blank[c].alias(c) for c in ("vulne_name", "open_time", "vulne_level", "vulne_type", "for_products")))
    about = lambda p: {k: p[k] for k in ("o_filename", "size", "file_format", "v_name", "v_type", "v_family", "platform")} | {"attack_action": _list(p["attack_action"])}
    load = Each(F.col("payloads"), lambda p: about(p) | {
        "fprocess_hash.md5": p["md5"], "loader_label": p["loader_label"], "loader_behavior_label": p["loader_behavior_label"],
        "vulne": F.transform(p["vulne"], hole), "detect.detect_time": when_, "detect.detect_pro_id": dev,
        "detect.detect_rule.detect_base": p["detect_base"], "detect.detect_rule.detect_id": p["detect_id"]}, or_default=True)
    loader = Each(F.col("payloads"), lambda p: about(p) | {"file_hash.md5": p["md5"]}, or_default=True)
    stages = F.create_map(*[F.lit(x) for kv in C.STAGE_NUMBER_EN.items() for x in kv])
    nsacss = F.flatten(F.transform(S._arr(F.col("d.sengine")), lambda h: F.transform(S._arr(h["nsacss"]), lambda n: F.struct(
        n["stage"].alias("stage"), n["objective"].alias("objective"), n["action"].alias("action"),
        F.try_element_at(stages, F.when(n["stage"] == "Presence", n["objective"]).otherwise(n["stage"])).alias("number")))))
    kinds = {"first_type": F.col("first_type"), "second_type": F.col("second_type"), "third_type": F.col("keyword")}
    own_url = lambda side: F.when(F.col(f"{side}_url") != "", T.first_or_empty(F.col("url")))
    out: dict[str, Any] = {"hbase_rowkey": F.col("hbase_rowkey"), "threat_info.sponsor_time": when_}
    for name, index, side in (("source", "Used_by_ES_src", "src"), ("purpose", "Used_by_ES_dst", "dst")):
        out |= {f"{index}.{name}_endpoint_ip": F.col(f"{side}.ip"), f"{index}.{name}_endpoint_port": F.col(f"{side}.port"),
                f"{index}.{name}_endpoint_domain": F.col(f"{side}_domain"), f"{index}.{name}_endpoint_url": own_url(side), f"{index}.{name}_endpoint_ip_cp": _unit(side)}
        out |= {f"threat_info.{name}_endpoint.{k}": c for k, c in _endpoint(side).items()}
    out |= {
        "Used_by_ES_src.source_load_attack_action": _list(F.col("search_attack_action")),
        **{f"Used_by_ES_src.source_load_attack_{k}": F.col(f"search_{k}") for k in ("v_name", "v_type", "v_family")},
        "Used_by_ES_ExtendInfo.alert": F.col("alert"), "Used_by_ES_ExtendInfo.is_malicious": F.col("is_malicious"), "Used_by_ES_ExtendInfo.detect_pro_id": dev,
        **{f"threat_info.event_type.{k}": c for k, c in kinds.items()}, **{f"threat_info.sponsor_behavior.attack_info.{k}": c for k, c in kinds.items()},
        **{f"threat_info.carrier.{k}": c for k, c in _carrier().items()},
        "threat_info.source_load": load, "threat_info.extend_details.loader_info": loader,
        "threat_info.sponsor_behavior.xw_label": F.col("xw_labels"), "threat_info.sponsor_behavior.xw_name": F.col("xw_labels"),
        "threat_info.sponsor_behavior.attack_label.attack": Each(F.col("attack_label"), lambda a: {
            "tactic": a["tactic"], "techniques": a["technique"], "tactic_number": a["tactic_number"], "techniques_number": a["technique_number"]}),
        "threat_info.sponsor_behavior.attack_label.nsacss": Each(nsacss, lambda n: {
            "stage": n["stage"], "objective": n["objective"], "action": n["action"], "stage_number": n["number"]}),
        **{f"threat_info.extend_details.attack_info.from_ip.{k}": S.geo("src")[k] for k in SE.GEO if k != "ASN"}}
    return out


@functools.cache
def _event() -> Column:
    return build(TEMPLATE, bindings())


def standard_event(alerts: DataFrame, details: DataFrame, techniques: DataFrame) -> DataFrame:
    """(id, hbase_rowkey, route, event): the nested event of every standardised alert.  ``details``: one row per
    address (``assets.asset_details``); ``techniques``: the dictionary with the new names in it."""
    full = with_attack_labels(with_assets(alerts, details), techniques)
    # a plain column: what reads parts of the event evaluates these only, compiled
    return full.select("id", "hbase_rowkey", "route", _event().alias("event"))
