"""Endpoint-agent events: decode, de-duplicate, allow-list, split, standardise.

Covers SRC-02, STR-02, FLT-12/13/14/15, DOM-22/24/26, JOIN-09/15, SCL-08 (endpoint form),
SCL-09/10/11/16, AGG-08 and SNK-06.  Message types are handled with one projection of
``when`` chains keyed by ``type`` (FLT-15) instead of one frame per type, so every type is
standardised in the same narrow stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_PARAMS, EngineParams
from ..functions import text as T
from ..functions.plan import bind, sieved
from ..sources import schemas
from .sensor import label_of


def _m(*parts: str) -> Column:
    """Short-key path, e.g. ``_m('data', 'i', '1')`` -> ``data.i.`1```."""
    c = F.col(parts[0])
    for p in parts[1:]:
        c = c[p]
    return c


_OFFSET = ("topic", "partition", "offset")


def decode(topic: DataFrame, dedupe: bool = True, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters).  Values that do not decode to a message with a type and a
    client go to the dead-letter frame instead of failing the batch (SNK-06, STR-13).
    Re-delivered offsets are dropped (STR-02) behind the decoding, so that the shuffle carries
    the decoded columns a query uses, never the raw JSON; only undecodable values travel whole.

    A query that uses the ``whole`` message reads the topic's offsets first: only messages whose offset may be there more than
    once are shuffled then, all of them if every message was delivered again."""
    if dedupe and whole:
        again = topic.groupBy(*_OFFSET).count().where("count > 1")
        place = F.xxhash64(*_OFFSET)
        once, twice = (decode(sieved(topic, place, again, place, inside), dedupe=inside) for inside in (False, True))
        return once[0].unionByName(twice[0]), once[1].unionByName(twice[1])
    m = bind(topic, _e=F.from_json(F.col("value"), schemas.ENDPOINT_EVENT))
    ok = F.col("_e.type").isNotNull() & F.col("_e.client").isNotNull()
    good = m.filter(ok).select("topic", "partition", "offset", "timestamp", "_e.*")
    bad = m.filter(~ok).select("topic", "partition", "offset", "timestamp", "value",
                               F.lit("undecodable").alias("reason"))
    if dedupe:
        good, bad = good.dropDuplicates(list(_OFFSET)), bad.dropDuplicates(list(_OFFSET))
    return good, bad


def gate(events: DataFrame, params: EngineParams = DEFAULT_PARAMS) -> DataFrame:
    """Endpoint-server allow-list (``-1`` = all), applied per row (Q5)."""
    if "-1" in params.endpoint_server_allow_list:
        return events
    return events.filter(F.col("client.server_ip").isin(*params.endpoint_server_allow_list))


def split_files(events: DataFrame, part: str | None = None) -> DataFrame:
    """DOM-22: a virus_defend message with several files becomes one event per file; every
    other message keeps its (single) file list.  ``part`` names a column for the event's number
    in its message."""
    multi = (F.col("type") == "virus_defend") & (F.size(F.coalesce("fileinfo", F.array())) > 1)
    one = F.when(multi, F.transform("fileinfo", lambda f: F.array(f))) \
           .otherwise(F.array(F.col("fileinfo")))
    if part is None:
        return events.withColumn("fileinfo", F.explode(one))
    return events.select(*[c for c in events.columns if c != "fileinfo"], F.posexplode(one).alias(part, "fileinfo"))


def endpoint_labels(name: Column) -> tuple[Column, Column]:
    """Endpoint form of SCL-08: the part before '/' split on '[' -> (category label,
    behaviour label without its closing bracket); case kept, unknown -> ''."""
    parts = F.split(F.split_part(F.coalesce(name, F.lit("")), F.lit("/"), F.lit(1)), r"\[")
    p1 = F.get(parts, 1)
    cat = F.when(F.size(parts) <= 2, label_of(F.get(parts, 0))).otherwise(F.lit(""))
    beh = F.when(F.size(parts) == 2, label_of(F.left(p1, F.length(p1) - 1))).otherwise(F.lit(""))
    return cat, beh


def malware_name() -> Column:
    """The malware name of any message type (eventlog: the process record; file-based legacy
    types: the file record; others: the top-level name); '' when absent."""
    is_log = F.col("type") == "eventlog"
    f0 = F.get(F.coalesce("fileinfo", F.array()), 0)
    return F.coalesce(F.when(is_log, F.get(_m("data", "i", "1"), 0)["8"])
                       .when(F.col("type").isin("virus_defend", "virus_detect"), f0["malname"])
                       .otherwise(F.col("malname")), F.lit(""))


def route_of(vname: Column) -> Column:
    """FLT-13 / FLT-14 / Q7: an eventlog without malware name is white; every other event is
    routed black."""
    return F.when(F.col("type") == "eventlog", F.when(vname == "", "white").otherwise("black")) \
            .otherwise(F.lit("black"))


def routes(events: DataFrame) -> DataFrame:
    """Per (split) event only what routing needs -- no dictionary or asset joins."""
    return split_files(events).select("timestamp", route_of(malware_name()).alias("route"))


def _source_ip() -> Column:
    told = F.nullif(F.get(_m("data", "d", "1"), 0)["1"], F.lit(""))
    return F.when(F.col("type") == "eventlog", F.coalesce(told, F.col("client.ip"))).otherwise(F.col("client.ip"))


@functools.cache
def _standard_exprs() -> tuple[tuple[tuple[str, Column], ...], tuple[Column, ...]]:
    """The per-message standardisation expressions (built once per process)."""
    is_log = F.col("type") == "eventlog"
    f0 = F.get(F.coalesce("fileinfo", F.array()), 0)
    i1 = F.get(_m("data", "i", "1"), 0)
    i3 = F.get(_m("data", "i", "3"), 0)
    legacy_path = (F.when(F.col("type").isin("virus_defend", "virus_detect"), f0["path"])
                    .when(F.col("type") == "proc_protect", F.col("child_process_path"))
                    .when(F.col("type") == "active_protect", F.col("registry_path")))
    att = F.split(F.coalesce(_m("data", "f", "7"), F.lit("")), r"\.")
    stg = F.split(F.coalesce(_m("data", "f", "5"), F.lit("")), r"\.")
    tac_map = F.create_map(*[F.lit(x) for kv in C.TACTIC_NUMBER_LOCAL.items() for x in kv])
    stg_map = F.create_map(*[F.lit(x) for kv in C.STAGE_NUMBER_LOCAL.items() for x in kv])
    det_map = F.create_map(*[F.lit(x) for kv in C.DETECT_OBJECT_BY_TYPE.items() for x in kv])
    first = {
        "rowkey": T.rowkey_offset(F.col("topic"), F.col("partition"), F.col("offset")),
        "eventlog_id": F.coalesce(_m("data", "a"), F.lit("")),
        "source_ip": _source_ip(),
        "_vname": malware_name(),
        "file_path": F.when(is_log, T.percent_decode(i1["3"])).otherwise(legacy_path),
        "_log_name": T.percent_decode(i1["4"]),
        "detect_obj": F.when(is_log, i3["6"]).otherwise(F.try_element_at(det_map, F.col("type"))),
        "tactic": F.when(is_log, F.coalesce(F.get(att, 0), F.lit(""))).otherwise(F.lit("")),
        "technique": F.when(is_log, F.coalesce(F.get(att, 1), F.lit(""))).otherwise(F.lit("")),
        "stage": F.when(is_log, F.coalesce(F.get(stg, 0), F.lit(""))).otherwise(F.lit("")),
        # read here: behind the joins it would take the whole message through their shuffles
        "_msg_unit": F.get(_m("data", "i", "3"), 0)["5"]["1"],
        "exploited_vuln": F.when(is_log, F.get(F.filter(F.coalesce(_m("data", "i", "2"), F.array()),
                                                        lambda v: v["1"] == _m("data", "f", "2", "1")), 0)["1"]),
    }
    cat, beh = endpoint_labels(F.col("_vname"))
    second = (
        F.col("_vname").alias("v_name"),
        F.when(is_log, F.col("_log_name")).otherwise(T.file_name_from_path(F.col("file_path"))).alias("file_name"),
        route_of(F.col("_vname")).alias("route"),
        F.when(is_log, F.col("_vname") != "").otherwise(F.col("type") != "active_protect").alias("is_malicious"),
        F.when(F.col("detect_obj") == C.DETECT_OBJECT_SOURCE_LOAD, "source").otherwise("purpose").alias("load_side"),
        F.coalesce(F.try_element_at(tac_map, F.col("tactic")), F.lit("")).alias("tactic_number"),
        F.coalesce(F.try_element_at(stg_map, F.col("stage")), F.lit("")).alias("stage_number"),
        cat.alias("category_label"), beh.alias("behaviour_label"),
    )
    return tuple(first.items()), second


def standardise(events: DataFrame, techniques: DataFrame, asset_lookup: DataFrame) -> DataFrame:
    """Flat standard-event columns for every message type (``endpoint_event`` nests them).

    ``techniques``: dictionary (attck_id, attck_content) already including newly registered
    techniques; ``asset_lookup``: one row per ``ip_addr`` with ``asset_id`` (JOIN-05)."""
    first, second = _standard_exprs()
    df = bind(events, barrier=False, **dict(first))
    df = df.select("*", *second).drop("_vname", "_log_name")
    t = techniques.groupBy(F.col("attck_content").alias("_tk")).agg(F.min("attck_id").alias("_tid"))
    # one row a name; a plain join would shuffle whole messages by it before its size is known
    df = df.join(F.broadcast(t), df["technique"] == t["_tk"], "left").drop("_tk")
    df = df.withColumn("technique_number",
                       F.when(F.col("tactic_number") != "", F.col("_tid").cast("string"))
                        .otherwise(F.lit(""))).drop("_tid")
    extra = [c for c in ("os_ver", "unit", "detail") if c in asset_lookup.columns]
    a = asset_lookup.select(F.col("ip_addr").alias("_aip"), F.col("asset_id").alias("_aid"),
                            *[F.col(c).alias(f"_a_{c}") for c in extra])
    df = df.join(a, df["source_ip"] == a["_aip"], "left").drop("_aip")
    known = F.col("_aid").isNotNull()
    # os and unit from the asset database when known, else from the message
    msg_unit = F.col("_msg_unit")
    os_ = F.coalesce(F.col("_a_os_ver"), F.lit("")) if "os_ver" in extra else F.lit("")
    if "unit" in extra:
        unit = F.when(known, F.coalesce(F.col("_a_unit"), F.lit(""))).otherwise(F.coalesce(msg_unit, F.lit("")))
    else:
        unit = F.coalesce(msg_unit, F.lit(""))
    out = (df.withColumn("asset_known", known)
             .withColumn("asset_id", F.coalesce("_aid", F.upper(F.md5(F.concat(F.lit("iep"), F.col("client.uuid"))))))
             .withColumn("asset_os", F.when(known, os_).otherwise(F.lit("")))
             .withColumn("asset_unit", unit))
    if "detail" in extra:
        out = out.withColumn("asset_detail", F.col("_a_detail"))
    return out.drop("_aid", "_msg_unit", *[f"_a_{c}" for c in extra])


def _technique() -> Column:
    return F.get(F.split(F.coalesce(_m("data", "f", "7"), F.lit("")), r"\."), 1)


def seen_techniques(events: DataFrame) -> DataFrame:
    """Distinct technique names (local form) reported by eventlog messages (AGG-20)."""
    return events.filter(F.col("type") == "eventlog").select(_technique().alias("attck_content")) \
        .filter(F.col("attck_content").isNotNull() & (F.col("attck_content") != "")).distinct()


def seen(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(technique names as ``seen_techniques``, addresses ``ip_addr`` that messages come from), of one reading of the messages:
    both are read from the same exchange."""
    pairs = events.select(_source_ip().alias("ip_addr"), F.when(F.col("type") == "eventlog", _technique()).alias("attck_content")).distinct()
    pairs = bind(pairs, ip_addr=F.col("ip_addr"), attck_content=F.col("attck_content"))  # so that a filter stays above the exchange
    return pairs.select("attck_content").filter("attck_content <> ''").distinct(), pairs.select("ip_addr")


def daily_counts(events: DataFrame) -> DataFrame:
    """AGG-08: per day, messages received after the allow-list and events routed black: one
    aggregate over the split events, of which each message has exactly one with number 0."""
    black = route_of(malware_name()) == "black"
    return split_files(events, part="_part").groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count_if(F.col("_part") == 0).alias("origin_count"), F.count_if(black).alias("black_count"))


def vulnerabilities(events: DataFrame) -> DataFrame:
    """DOM-24: the vulnerability list of an eventlog with its patches nested, as one object
    (the reference's two views share it, so both carry the patches), plus the id list."""
    v = F.transform(F.coalesce(_m("data", "i", "2"), F.array()), lambda x: F.struct(
        x["1"].alias("vulne_id"), x["2"].alias("vulne_name"),
        F.transform(F.coalesce(x["8"], F.array()), lambda p: F.struct(
            p["1"].alias("patch_id"), p["2"].alias("patch_name"))).alias("patch_info")))
    return events.filter(F.col("type") == "eventlog").select(
        T.rowkey_offset(F.col("topic"), F.col("partition"), F.col("offset")).alias("rowkey"),
        v.alias("vulne"), F.transform(v, lambda x: x["vulne_id"]).alias("vulne_ids"))
