"""Network-sensor alerts: decode, gate, scene, orientation, threat type, payloads, labels,
carriers and the standard event.

Covers SRC-03, FLT-09/10/11, DOM-01..19, JOIN-10/11/12/13/14, SCL-06/07/08/13/17/18/24/25,
AGG-09/10/11 and SNK-02.  All per-alert logic is row-local (``when`` chains and
higher-order functions over the alert's own arrays), so the flow is one narrow stage;
only the counters and the ATT&CK lookup shuffle.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_PARAMS, EngineParams
from ..functions import text as T
from ..functions.plan import bind
from ..sources import schemas

# FIXED VALUES -- user-defined sensor labels that become behaviour labels.
USER_DEFINED_LABELS = ["跨境通讯", "动态域名", "邮件通讯", "跨域邮件", "带链接邮件"]
# FIXED VALUES -- label prefixes per engine and the file-direction labels.
C2_ENGINE = "C2引擎"
SENGINE = "sengine"
AVL_ENGINE = "AVL引擎"
C2_LABEL = "C2引擎:C2通信"
UPLOAD_LABEL = "AVL引擎:上传文件"
DOWNLOAD_LABEL = "AVL引擎:下载文件"
USER_DEFINED = "user_defined"

PAYLOAD_T = ("struct<engine:string,v_name:string,v_type:string,v_family:string,platform:string,"
             "attack_action:string,md5:string,o_filename:string,size:string,file_format:string,"
             "loader_label:array<string>,loader_behavior_label:array<string>,vulne:array<string>,"
             "detect_base:string,detect_id:string>")


@functools.cache
def label_map_col() -> Column:
    return F.create_map(*[F.lit(x) for kv in C.LABEL_MAP.items() for x in kv])


def label_of(key: Column) -> Column:
    """Label of a category / behaviour key, '' when unknown (JOIN-13)."""
    return F.coalesce(F.try_element_at(label_map_col(), key), F.lit(""))


def _empty(t: str) -> Column:
    return F.array().cast(f"array<{t}>")


def _arr(c: Column) -> Column:
    return F.coalesce(c, F.array())


# --- SRC-03 / FLT-09..11 ----------------------------------------------------------------

def decode_batches(topic: DataFrame) -> DataFrame:
    """``{"data": [alert, ...]}`` messages -> one row per alert with its position and the
    size of its batch (for true origin counts, Q4)."""
    m = bind(topic, _m=F.from_json(F.col("value"), schemas.SENSOR_BATCH))
    ex = m.select("topic", "partition", "offset", "timestamp",
                  F.size(_arr(F.col("_m.data"))).alias("batch_size"),
                  F.posexplode(_arr(F.col("_m.data"))).alias("pos", "e"))
    return ex.select("topic", "partition", "offset", "timestamp", "batch_size", "pos", "e.*")


def gate(alerts: DataFrame, params: EngineParams = DEFAULT_PARAMS) -> DataFrame:
    """Allow-listed sensors (``-1`` = all; per row, not a batch break, Q5), no heartbeats,
    only malicious or alerting rows."""
    out = alerts
    if "-1" not in params.sensor_allow_list:
        out = out.filter(F.col("dev").isin(*params.sensor_allow_list))
    out = out.filter(~F.coalesce(F.col("type") == "heartbeat", F.lit(False)))
    return out.filter(F.coalesce(F.col("is_malicious"), F.lit(False)) | F.coalesce(F.col("alert"), F.lit(False)))


# --- DOM-01 / DOM-02 ---------------------------------------------------------------------

def _proto_has(p: str) -> Column:
    return F.coalesce(F.array_contains(F.col("proto"), p), F.lit(False))


def _proto0() -> Column:
    return F.get(F.col("proto"), 0)


def _upload_md5() -> Column:
    return F.col("msg.upload.md5")


@functools.cache
def scene() -> Column:
    """Which side attacks, 'src' or 'dst' (§2.13-A)."""
    has_file = F.col("d.file").isNotNull()
    has_sengine = F.col("d.sengine").isNotNull()
    mail = F.coalesce(_proto0().isin(*C.MAIL_PROTOCOLS), F.lit(False))
    up = _upload_md5()
    file_side = (F.when(mail, F.when(_proto_has("SMTP"), "src").otherwise("dst"))
                  .when(_proto_has("FTP"), F.when(T.truthy(up), "src").otherwise("dst"))
                  .when(F.col("msg").isNotNull() & F.coalesce(up != "", F.lit(False)),
                        F.when(F.coalesce(_proto0().isin("SMB", "NFS"), F.lit(False)), "src").otherwise("dst"))
                  .otherwise("dst"))
    return F.when(has_file, file_side).when(has_sengine, "src").otherwise("dst")


@functools.cache
def swap_flag() -> Column:
    """Orientation (§2.13-B): only the first avlist entry / first engine hit is inspected;
    the flag is per row (the reference's never-reset global is fixed, Q6)."""
    av = _arr(F.col("avlist"))
    se = _arr(F.col("d.sengine"))
    attacker = F.get(se, 0)["related"]["attacker"]
    att0 = F.get(attacker, 0)
    by_scene = F.col("scene") == "dst"
    return (F.when(F.size(av) > 0, F.coalesce(F.get(av, 0)["victim"]["name"] == F.col("src.ip"), F.lit(False)))
             .when(F.size(se) > 0, F.when(F.size(_arr(attacker)) > 0,
                                          F.coalesce(att0 == F.col("dst.ip"), F.lit(False)))
                                    .otherwise(by_scene))
             .otherwise(by_scene))


def orient(df: DataFrame) -> DataFrame:
    df = bind(df, scene=scene())
    df = bind(df, swapped=swap_flag())
    s = F.col("swapped")
    return bind(df, src=F.when(s, F.col("dst")).otherwise(F.col("src")),
                dst=F.when(s, F.col("src")).otherwise(F.col("dst")))


# --- DOM-03 / DOM-04 ---------------------------------------------------------------------

@functools.cache
def threat_type() -> tuple[Column, Column]:
    """(flag, action keyword) per §2.13-C; flag in c2 / md5 / vul, NULL when ``d`` is empty."""
    d = F.col("d")
    c2 = F.col("d.url").isNotNull() | F.col("d.domain").isNotNull() | F.col("d.ip").isNotNull()
    has_file = F.col("d.file").isNotNull()
    has_sengine = F.col("d.sengine").isNotNull()
    mal0 = F.coalesce(F.get(F.col("malname"), 0), F.lit(""))
    up = _upload_md5()
    mail = F.coalesce(_proto0().isin(*C.MAIL_PROTOCOLS), F.lit(False))
    taint = F.when(mal0.contains("Virus") | mal0.contains("Exploit"), F.lit(C.ACTION_TAINT_SHARED)) \
             .otherwise(F.lit(C.ACTION_REMOTE_SHARE_WRITE))
    md5_kw = (F.when(_proto_has("HTTP"), F.lit(C.ACTION_WEB_IMPLANT))
               .when(mail, F.when(_proto_has("SMTP"), F.lit(C.ACTION_INFECTED_HOST))
                             .otherwise(F.lit(C.ACTION_MALICIOUS_MAIL)))
               .when(_proto_has("FTP"), F.when(F.col("msg").isNull(), F.lit(None))
                                         .when(T.truthy(up), F.lit(C.ACTION_REMOTE_SHARE_WRITE))
                                         .otherwise(F.lit(C.ACTION_LEGIT_REMOTE_ACCESS)))
               .when(F.col("msg").isNotNull() & ~up.eqNullSafe(""),   # a missing digest is not an empty one
                     F.when(_proto0().isin("SMB", "NFS"), taint)
                      .when(_proto0() == "FEIQ", F.lit(C.ACTION_CHAT))))
    # engine hits: the last hit that matches a rule decides
    firmware = lambda m: F.exists(F.array(*[F.lit(w) for w in C.VENDOR_FIRMWARE_WORDS]),
                                  lambda w: m.contains(w))
    per_hit = F.transform(_arr(F.col("d.sengine")), lambda h: (
        F.when(firmware(F.coalesce(h["msg"], F.lit(""))), F.lit(C.ACTION_FIRMWARE_VULN))
         .when(h["classtype"] == "web-application-attack",
               F.when(F.upper(F.coalesce(h["msg"], F.lit(""))).contains("SQL"), F.lit(C.ACTION_DB_INJECTION))
                .otherwise(F.lit(C.ACTION_REMOTE_APP_VULN)))))
    vul_kw = F.try_element_at(F.filter(per_hit, lambda k: k.isNotNull()), F.lit(-1))
    vul_kw = F.when(F.size(F.filter(per_hit, lambda k: k.isNotNull())) > 0, vul_kw)
    flag = (F.when(d.isNull(), F.lit(None)).when(c2, "c2").when(has_file, "md5")
             .when(has_sengine, "vul"))
    kw = (F.when(flag == "c2", F.lit(C.ACTION_C2)).when(flag == "md5", md5_kw)
           .when(flag == "vul", vul_kw))
    return flag, kw


def event_type_names(flag: Column) -> tuple[Column, Column]:
    first, second = F.lit(""), F.lit("")
    for k, (a, b) in C.EVENT_NAMES.items():
        first = F.when(flag == k, F.lit(a)).otherwise(first)
        second = F.when(flag == k, F.lit(b)).otherwise(second)
    return first, second


def classify(df: DataFrame) -> DataFrame:
    flag, kw = threat_type()
    df = bind(df, barrier=False, threat_flag=flag, keyword=T.empty_if_null(kw))
    a, b = event_type_names(F.col("threat_flag"))
    return bind(df, barrier=False, first_type=a, second_type=b)


# --- DOM-05 .. DOM-10 (payloads and behaviour labels) -------------------------------------

def _no_bracket(name: Column) -> Column:
    return ~F.coalesce(name, F.lit("")).contains("[")


def _loader_label(engine: str, name: Column, always_when_bracket: bool = True) -> Column:
    """Category label list of a hit: without ``[..]`` the part before '/' if known; with it
    the part before '[' (kept even when unknown)."""
    n = F.coalesce(name, F.lit(""))
    plain = label_of(F.lower(F.split_part(n, F.lit("/"), F.lit(1))))
    brk = label_of(F.lower(F.split_part(n, F.lit("["), F.lit(1))))
    return F.when(_no_bracket(n), F.when(plain != "", F.array(F.concat(F.lit(engine + ":"), plain)))
                  .otherwise(_empty("string"))) \
            .otherwise(F.array(F.concat(F.lit(engine + ":"), brk)))


def _behaviour_label(engine: str, name: Column) -> Column:
    n = F.coalesce(name, F.lit(""))
    beh = label_of(F.lower(F.regexp_extract(n, r"\[(.*?)\]", 1)))
    return F.when(~_no_bracket(n) & (beh != ""), F.array(F.concat(F.lit(engine + ":"), beh))) \
            .otherwise(_empty("string"))


def _payload(engine: str, h, *, md5=None, info=None, loader=None, behaviour=None, vulne=None) -> Column:
    nul = F.lit(None).cast("string")
    return F.struct(
        F.lit(engine).alias("engine"),
        (h["malname"] if h is not None else nul).alias("v_name"),
        (h["virus_type"] if h is not None else nul).alias("v_type"),
        (h["virus_family"] if h is not None else nul).alias("v_family"),
        (h["virus_platform"] if h is not None else nul).alias("platform"),
        (h["virus_behaviors"] if h is not None else nul).alias("attack_action"),
        (md5 if md5 is not None else nul).alias("md5"),
        (T.percent_decode(info["name"]) if info is not None else nul).alias("o_filename"),
        (info["bytes"] if info is not None else nul).alias("size"),
        (info["type"] if info is not None else nul).alias("file_format"),
        (loader if loader is not None else _empty("string")).alias("loader_label"),
        (behaviour if behaviour is not None else _empty("string")).alias("loader_behavior_label"),
        (vulne if vulne is not None else _empty("string")).alias("vulne"),
        (h["author"] if h is not None else nul).alias("detect_base"),
        (h["rid"] if h is not None else nul).alias("detect_id"),
    ).cast(PAYLOAD_T)


def _file_info_by_md5(info: Column, md5: Column) -> Column:
    """Last file-info entry with this md5 (JOIN-14)."""
    return F.try_element_at(F.filter(info, lambda f: f["md5"] == md5), F.lit(-1))


def _direction_label(f: Column) -> Column:
    return (F.when(f["direction"] == "up", F.array(F.lit(UPLOAD_LABEL)))
             .when(f["direction"] == "down", F.array(F.lit(DOWNLOAD_LABEL)))
             .otherwise(_empty("string")))


@functools.cache
def _payload_stages() -> tuple[tuple[tuple[str, Column], ...], ...]:
    """Payload and label expressions as two successive bindings (built once)."""
    info = _arr(F.col("file"))
    has_info = F.size(info) > 0
    dfile = _arr(F.col("d.file"))
    c2 = lambda arr: F.transform(_arr(arr), lambda h: _payload(
        "C2", h, loader=F.array(F.concat(F.lit(C2_ENGINE + ":"),
                                         label_of(F.lower(F.split_part(F.coalesce(h["malname"], F.lit("")),
                                                                       F.lit("/"), F.lit(1))))))))
    url_p, dom_p, ip_p = c2(F.col("d.url")), c2(F.col("d.domain")), c2(F.col("d.ip"))
    se_p = F.transform(_arr(F.col("d.sengine")), lambda h: _payload(
        "sengine", h, behaviour=_behaviour_label(SENGINE, h["malname"]),
        vulne=T.cve_ids(_arr(h["reference"]))))
    file_p = F.transform(
        F.filter(dfile, lambda h: ~has_info | _file_info_by_md5(info, h["md5"]).isNotNull()),
        lambda h: _payload("AVL", h, md5=h["md5"],
                           info=F.when(has_info, _file_info_by_md5(info, h["md5"])),
                           loader=_loader_label(AVL_ENGINE, h["malname"]),
                           behaviour=_behaviour_label(AVL_ENGINE, h["malname"])))
    only_md5 = F.when((F.size(dfile) == 0) & has_info,
                      F.array_distinct(F.transform(info, lambda f: f["md5"]))).otherwise(_empty("string"))
    only_p = F.transform(only_md5, lambda m: _payload("file-only", None, md5=m,
                                                      info=_file_info_by_md5(info, m)))
    first = {"_url_p": url_p, "_se_p": se_p, "_file_p": file_p, "_only_p": only_p, "_dom_p": dom_p, "_ip_p": ip_p}

    # behaviour labels, in the order the alert is walked
    user = F.when(F.col("label").isin(*USER_DEFINED_LABELS),
                  F.array(F.concat(F.lit(USER_DEFINED + ":"), F.col("label")))).otherwise(_empty("string"))
    c2lab = lambda p: F.when(F.size(p) > 0, F.array(F.lit(C2_LABEL))).otherwise(_empty("string"))
    se_lab = F.flatten(F.transform(_arr(F.col("d.sengine")),
                                   lambda h: _loader_label(SENGINE, h["malname"])))
    file_lab = F.flatten(F.transform(
        F.filter(dfile, lambda h: has_info & _file_info_by_md5(info, h["md5"]).isNotNull()),
        lambda h: _direction_label(_file_info_by_md5(info, h["md5"]))))
    only_lab = F.flatten(F.transform(only_md5, lambda m: _direction_label(_file_info_by_md5(info, m))))
    labels = F.concat(user, c2lab(F.col("_url_p")), se_lab, file_lab, only_lab,
                      c2lab(F.col("_dom_p")), c2lab(F.col("_ip_p")))
    all_p = F.concat("_url_p", "_se_p", "_file_p", "_only_p", "_dom_p", "_ip_p")
    detections = F.concat("_url_p", "_se_p", "_file_p", "_dom_p", "_ip_p")
    second = {"payloads": all_p, "xw_labels": labels, "_last": F.try_element_at(detections, F.lit(-1))}
    return tuple(first.items()), tuple(second.items())


def payloads(df: DataFrame) -> DataFrame:
    """Adds ``payloads`` (ordered: url, engine, file, file-only, domain, ip), ``xw_labels``
    and the search columns taken from the last detection payload."""
    for st in _payload_stages():
        df = bind(df, barrier=False, **dict(st))
    return (df.withColumn("search_v_name", F.col("_last.v_name"))
              .withColumn("search_v_type", F.col("_last.v_type"))
              .withColumn("search_v_family", F.col("_last.v_family"))
              .withColumn("search_attack_action", F.col("_last.attack_action"))
              .drop("_url_p", "_se_p", "_file_p", "_only_p", "_dom_p", "_ip_p", "_last"))


# --- DOM-06 attack labels (JOIN-10/11/12, SCL-17/18, DOM-29) ------------------------------

def attack_labels(alerts: DataFrame, techniques: DataFrame) -> DataFrame:
    """One row per (alert, engine hit, tactic): tactic split on ',' (one leading space
    dropped), tactic number, technique id from the dictionary by English name (left join,
    NULL when unknown), kill-chain stage number ("Presence" is looked up by objective)."""
    tac = F.create_map(*[F.lit(x) for kv in C.TACTIC_NUMBER_EN.items() for x in kv])
    stg = F.create_map(*[F.lit(x) for kv in C.STAGE_NUMBER_EN.items() for x in kv])
    hits = alerts.select("id", F.posexplode(_arr(F.col("d.sengine"))).alias("hit_pos", "h"))
    hits = hits.withColumn("cve", F.get(T.cve_ids(_arr(F.col("h.reference"))), 0))
    atk = hits.select("id", "hit_pos", "cve", F.col("h.nsacss").alias("nsacss"),
                      F.posexplode(_arr(F.col("h.attck"))).alias("attck_pos", "a"))
    tl = atk.select("id", "hit_pos", "cve", "attck_pos", "nsacss", F.col("a.techniques").alias("technique"),
                    F.posexplode(T.split_trim_first_space(F.col("a.tactic"))).alias("tactic_pos", "tactic"))
    n0 = F.get(_arr(F.col("nsacss")), 0)
    stage_key = F.when(n0["stage"] == "Presence", n0["objective"]).otherwise(n0["stage"])
    tl = tl.select("id", "hit_pos", "cve", "attck_pos", "tactic_pos", "technique", "tactic",
                   F.coalesce(F.try_element_at(tac, F.col("tactic")), F.lit("")).alias("tactic_number"),
                   n0["stage"].alias("stage"),
                   F.coalesce(F.try_element_at(stg, stage_key), F.lit("")).alias("stage_number"))
    t = techniques.select(F.col("attck_eng_name").alias("technique"),
                          F.col("attck_id").alias("technique_number"))
    return tl.join(t, "technique", "left")


# --- DOM-11 .. DOM-19 (endpoints and carriers) ---------------------------------------------

@functools.cache
def _carrier_exprs() -> tuple[tuple[tuple[str, Column], ...], tuple[tuple[str, Column], ...]]:
    proto = (F.when(F.col("msg").isNotNull(), "smb").when(F.col("http").isNotNull(), "http")
              .when(F.col("ftp").isNotNull(), "ftp").when(F.col("email").isNotNull(), "email")
              .when(F.col("dns").isNotNull(), "dns"))
    url = T.percent_decode(T.first_or_empty(F.col("url")))
    dom = T.first_or_empty(F.col("domain"))
    dom = F.when((dom == "") & (url != ""), F.coalesce(T.url_authority(url), F.lit(""))).otherwise(dom)
    s = F.col("swapped")
    dns_side = F.when(F.col("dns.msg.msg_type") == "query", F.when(s, "src").otherwise("dst")) \
                .otherwise(F.when(s, "dst").otherwise("src"))
    side = (F.when(F.col("http").isNotNull(), F.when(s, "src").otherwise("dst"))
             .when(F.col("dns").isNotNull(), dns_side))
    rec0 = F.get(_arr(F.col("dns.msg.record")), 0)
    first = {"protocol": proto, "_url": url, "_dom": dom, "_side": side}
    second = {
        "src_url": F.when(F.col("_side") == "src", F.col("_url")).otherwise(F.lit("")),
        "src_domain": F.when(F.col("_side") == "src", F.col("_dom")).otherwise(F.lit("")),
        "dst_url": F.when(F.col("_side") == "dst", F.col("_url")).otherwise(F.lit("")),
        "dst_domain": F.when(F.col("_side") == "dst", F.col("_dom")).otherwise(F.lit("")),
        "dns_info": F.struct(
            T.empty_if_null(F.col("dns.msg.msg_type")).alias("message_type"),
            rec0["Rtype"].alias("record_type"), T.empty_if_null(rec0["class"]).alias("pro_info"),
            T.empty_if_null(rec0["cname"]).alias("alias"), rec0["data"].alias("return_data")),
        "email_info": F.struct(
            T.empty_if_null(F.col("email.msg.from")).alias("from"),
            T.first_or_empty(F.col("email.msg.to")).alias("to"),
            T.empty_if_null(F.col("email.msg.sender")).alias("sender"),
            T.empty_if_null(F.col("email.msg.sub")).alias("sub"),
            T.empty_if_null(F.col("email.msg.content")).alias("text"),
            F.transform(_arr(F.col("email.msg.attach")), lambda a: F.struct(
                T.empty_if_null(a["md5"]).alias("md5"), T.empty_if_null(a["fn"]).alias("file_name"),
                T.empty_if_null(a["ft"]).alias("file_format"))).alias("file")),
        "ftp_info": F.struct(F.col("ftp.upload").alias("upload"), F.col("ftp.download").alias("download")),
        "http_info": F.struct(
            F.col("http.request.method").alias("method"),
            F.concat(F.col("http.request.header.host"), F.col("http.request.header.uri")).alias("URL"),
            T.header_map(F.col("http.request.header.other")).alias("request_headers"),
            T.header_map(F.col("http.response.header.other")).alias("response_headers"),
            F.col("http.request.body").alias("request_body"),
            F.col("http.response.body").alias("response_body")),
        "smb_info": F.struct(F.col("msg.upload").alias("upload"), F.col("msg.download").alias("download")),
    }
    return tuple(first.items()), tuple(second.items())


def carriers(df: DataFrame) -> DataFrame:
    """Protocol (last present of dns < email < ftp < http < smb; NULL when none) and the
    flattened carrier fields; URL/domain ownership by query direction and orientation."""
    first, second = _carrier_exprs()
    df = bind(df, barrier=False, **dict(first))
    return df.withColumns(dict(second)).drop("_url", "_dom", "_side")


def geo(side: str) -> Column:
    """Endpoint geo block (longitude from ``lon``: the reference's overwrite is fixed, Q6)."""
    e = F.col(side)
    return F.struct(e["ip"].alias("ip"), T.empty_if_null(e["country"]).alias("country"),
                    T.empty_if_null(e["city"]).alias("city"), T.empty_if_null(e["region"]).alias("region"),
                    T.empty_if_null(e["unit"]).alias("units"), T.empty_if_null(e["isp"]).alias("operators"),
                    T.empty_if_null(e["location"]["lon"]).alias("longitude"),
                    T.empty_if_null(e["location"]["lat"]).alias("latitude"))


def unit_precedence(asset_unit: Column, sensor_unit: Column) -> Column:
    """DOM-12: the asset database's unit, else the sensor's."""
    return F.coalesce(F.nullif(asset_unit, F.lit("")), T.empty_if_null(sensor_unit))


def route() -> Column:
    """SNK-02: black when malicious or alerting, else white."""
    return F.when(F.coalesce(F.col("is_malicious"), F.lit(False)) | F.coalesce(F.col("alert"), F.lit(False)),
                  "black").otherwise("white")


def standardise(topic: DataFrame, params: EngineParams = DEFAULT_PARAMS) -> DataFrame:
    """Topic of sensor batches -> enriched alert rows (flat columns + payload arrays)."""
    a = gate(decode_batches(topic), params)
    a = orient(a)
    a = classify(a)
    a = payloads(a)
    a = carriers(a)
    return a.withColumn("hbase_rowkey", T.rowkey_md5_mid(F.col("id"))).withColumn("route", route())


def not_heartbeat() -> Column:
    """An alert without a type is no heartbeat."""
    return ~F.col("type").eqNullSafe("heartbeat")


def daily_counts(decoded: DataFrame) -> DataFrame:
    """AGG-09 / AGG-10: per day, alerts received (true row count, Q4), black and white."""
    r = route()
    return decoded.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("origin_count"),
        F.count_if((r == "black") & not_heartbeat()).alias("black_count"),
        F.count_if((r == "white") & not_heartbeat()).alias("white_count"))


def device_seen(decoded: DataFrame) -> DataFrame:
    """AGG-11 for sensors: first and last report per device (heartbeats included)."""
    return decoded.groupBy("dev").agg(F.min("timestamp").alias("first_seen"),
                                      F.max("timestamp").alias("last_seen"),
                                      F.count(F.lit(1)).alias("n"))


# --- JOIN-04 / FLT-18 / DOM-12 / SCL-14 (asset enrichment of both endpoints) ---------------

def enrich_assets(alerts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Both endpoints of an oriented alert joined with the asset profile (one row per
    address: ``ip_addr, asset_id, unit``).  The destination lookup is skipped when the
    reply carried neither packets nor bytes (FLT-18); the unit comes from the asset
    database, else from the sensor (DOM-12); an unknown private address gets the stable
    id ``md5(device || ip)`` for registration (SCL-14)."""
    from ..functions import net as N

    lk = lookup.select("ip_addr", "asset_id", "unit")
    s = lk.select(F.col("ip_addr").alias("_sip"), F.col("asset_id").alias("src_asset_id"),
                  F.col("unit").alias("_sunit"))
    d = lk.select(F.col("ip_addr").alias("_dip"), F.col("asset_id").alias("dst_asset_id"),
                  F.col("unit").alias("_dunit"))
    skip = (F.coalesce(F.col("s2c.pkts"), F.lit(0)) == 0) & (F.coalesce(F.col("s2c.bytes"), F.lit(0)) == 0)
    a = alerts.withColumn("dst_lookup_skipped", skip)
    a = a.join(s, a["src.ip"] == s["_sip"], "left")
    a = a.join(d, (a["dst.ip"] == d["_dip"]) & ~a["dst_lookup_skipped"], "left")
    new_id = lambda ip, known: F.when(N.is_private(ip) & known.isNull(), F.md5(F.concat(F.col("dev"), ip)))
    return (a.withColumn("src_unit", unit_precedence(F.col("_sunit"), F.col("src.unit")))
             .withColumn("dst_unit", unit_precedence(F.col("_dunit"), F.col("dst.unit")))
             .withColumn("src_new_asset_id", new_id(F.col("src.ip"), F.col("src_asset_id")))
             .drop("_sip", "_dip", "_sunit", "_dunit"))
