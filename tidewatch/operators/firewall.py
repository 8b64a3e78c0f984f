"""Firewall syslog: envelope decode, vendor classification, detail parse, rename, counters.

Covers SRC-01, FLT-01..08, SCL-01/02, AGG-01..07, SNK-01 and the Q3/Q16 decisions.
Every step is a ``Column`` expression over the row, so the whole flow is one narrow
stage (no shuffle) up to the counters, which shuffle once on their small group keys
after map-side partial aggregation.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from ..functions.plan import bind

ENVELOPE_SCHEMA = "data STRING, host STRING"


# --- SRC-01 -----------------------------------------------------------------------------

def decode_envelope(topic: DataFrame, value_col: str = "value") -> DataFrame:
    """``{data, host}`` JSON envelope; when the value is not such JSON the raw text becomes
    ``data`` and ``host`` is NULL."""
    df = bind(topic, _env=F.from_json(F.col(value_col), ENVELOPE_SCHEMA))
    ok = F.col("_env.data").isNotNull()
    return bind(df, data=F.when(ok, F.col("_env.data")).otherwise(F.col(value_col)),
                host=F.when(ok, F.col("_env.host"))).drop("_env")


# --- FLT-01 / FLT-02 ----------------------------------------------------------------------

def split_pri(data: Column) -> tuple[Column, Column]:
    """(pri, message): text between '<' and the first '>' as INT (NULL if not a number) and
    the text after the first '>' (the whole line when there is no '>')."""
    pos = F.instr(data, ">")
    msg = F.when(pos > 0, F.substring(data, pos + 1, F.length(data))).otherwise(data)
    pri = F.when(pos > 1, F.trim(F.substring(data, F.lit(2), pos - 2)).try_cast("int"))
    return pri, msg


def severity(pri: Column) -> Column:
    return pri.bitwiseAND(7)


def facility(pri: Column) -> Column:
    return F.shiftright(pri.bitwiseAND(0x3F8), 3)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _first_match(s: Column, patterns: list[str]) -> Column:
    """1-based index of the first pattern matching the start of ``s``; NULL if none."""
    out = F.lit(None).cast("int")
    for i in range(len(patterns), 0, -1):
        out = F.when(T.match_start(s, patterns[i - 1]), F.lit(i)).otherwise(out)
    return out


def _detail_groups(vendor: str, pattern: str) -> list[str]:
    """Groups a matched detail rule must yield: message halves + captures for k=v vendors,
    every named group otherwise."""
    names = T.group_names(pattern)
    if vendor in C.KV_VENDOR_CAPTURES and names:
        return ["message1", "message2"] + [n for n in C.KV_VENDOR_CAPTURES[vendor] if n in names]
    return names


def _detail_map(vendor: str, pattern: str, g: Column) -> Column:
    """The key/value map a matched detail rule yields for ``vendor`` from its extracted
    groups ``g`` (an attribute bound once, so the regex runs once per row)."""
    names = T.group_names(pattern)
    if not names:
        return F.create_map().cast("map<string,string>")
    if vendor in C.KV_VENDOR_CAPTURES:
        caps = _detail_groups(vendor, pattern)[2:]
        tokens = T.kv_tokens(F.concat(g[0], F.lit(" "), g[1]))
        if not caps:
            return tokens
        capmap = F.map_from_arrays(F.array(*[F.lit(n) for n in caps]), F.slice(g, 3, len(caps)))
        return F.map_concat(capmap, tokens)
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), g)


# --- FLT-03 .. FLT-06 ---------------------------------------------------------------------

@functools.cache
def _classify_stages() -> tuple[tuple[tuple[str, Column], ...], ...]:
    """The classification as successive column bindings (built once per process: the
    expression trees are large, so they are not rebuilt for every query)."""
    pri, msg = split_pri(F.col("data"))
    vendors = [v for v, _, _ in C.VENDOR_RULES]
    patterns = [p for _, _, p in C.VENDOR_RULES]
    stages: list[dict[str, Column]] = [{"pri": pri, "msg": _strip(msg)},
                                       {"_vi": _first_match(F.col("msg"), patterns)}]
    vendor, fire_type = F.lit(None).cast("string"), F.lit(None).cast("string")
    parts = F.lit(None).cast("array<string>")
    for i, (v, t, p) in enumerate(C.VENDOR_RULES, 1):
        vendor = F.when(F.col("_vi") == i, F.lit(v)).otherwise(vendor)
        fire_type = F.when(F.col("_vi") == i, F.lit(t)).otherwise(fire_type)
        parts = F.when(F.col("_vi") == i, T.extract_groups(F.col("msg"), p, ["type", "message"])).otherwise(parts)
    stages.append({"vendor": vendor, "fire_type": fire_type, "_tm": parts})
    stages.append({"log_type": _strip(F.col("_tm")[0]), "body": _strip(F.col("_tm")[1])})

    di = F.lit(None).cast("int")
    for v in vendors:
        di = F.when(F.col("vendor") == v, _first_match(F.col("body"), C.VENDOR_DETAIL_RULES[v])).otherwise(di)
    stages.append({"_di": di})

    groups = F.lit(None).cast("array<string>")
    detail = F.lit(None).cast("map<string,string>")
    for v in vendors:
        for j, p in enumerate(C.VENDOR_DETAIL_RULES[v], 1):
            hit = (F.col("vendor") == v) & (F.col("_di") == j)
            names = _detail_groups(v, p)
            if names:
                groups = F.when(hit, T.extract_groups(F.col("body"), p, names)).otherwise(groups)
            detail = F.when(hit, _detail_map(v, p, F.col("_g"))).otherwise(detail)
    stages.append({"_g": groups})
    stages.append({"detail": detail})

    gate_ok = ~((F.col("vendor") == "star") & ~F.col("log_type").isin(*C.STAR_KEPT_TYPES))
    black = F.col("_di").isNotNull() & gate_ok
    has_sip_key = F.coalesce(F.map_contains_key(F.col("detail"), F.lit("SrcIP")), F.lit(False))
    sip_val = F.coalesce(F.col("detail")["SrcIP"], F.lit(""))
    reason = (F.when(F.col("vendor").isNull(), F.lit("unclassified"))
               .when(F.col("_di").isNull(), F.lit("detail_no_match"))
               .when(~gate_ok, F.lit("type_filtered"))
               .when(~has_sip_key, F.lit("missing_srcip"))
               .when(sip_val == "", F.lit("empty_srcip"))
               .when(F.col("pri").isNull(), F.lit("bad_pri")))
    stages.append({"origin": F.col("vendor").isNotNull().cast("int"),
                   "black": F.coalesce(black, F.lit(False)).cast("int"), "reason": reason})
    return tuple(tuple(st.items()) for st in stages)


def classify(env: DataFrame) -> DataFrame:
    """Adds ``pri, msg, vendor, fire_type, log_type, detail, origin, black, accepted, reason``.

    ``origin`` = 1 when a vendor rule matched; ``black`` = 1 once the detail rule matched
    and the type gate passed -- set *before* the empty-source-ip reject (Q3).
    """
    df = env
    for st in _classify_stages():
        df = bind(df, **dict(st))
    return df.withColumn("accepted", F.col("reason").isNull()).drop("_vi", "_di", "_tm", "_g")


# --- FLT-07 / FLT-08 ---------------------------------------------------------------------

def target_fields() -> list[str]:
    seen: list[str] = []
    for m in (C.RENAME_MAP_12, C.RENAME_MAP_4):
        for t in m.values():
            if t not in seen:
                seen.append(t)
    return seen


def _renamed(target: str) -> Column:
    out = F.lit("")
    for ft, m in C.RENAME_MAPS.items():
        srcs = [k for k, t in m.items() if t == target]
        if not srcs:
            continue
        val = F.coalesce(*[F.col("detail")[s] for s in reversed(srcs)], F.lit(""))
        out = F.when(F.col("fire_type") == ft, val).otherwise(out)
    return out


@functools.cache
def _normalised_columns(ts_col: str, seed_cols: tuple[str, ...]) -> tuple[Column, ...]:
    """The output columns of ``normalise`` (built once per process: ~40 rename cases)."""
    mapped_cases = F.lit(None).cast("array<string>")
    for ft, m in C.RENAME_MAPS.items():
        mapped_cases = F.when(F.col("fire_type") == ft,
                              F.array(*[F.lit(k) for k in m])).otherwise(mapped_cases)
    return tuple([
        T.rowkey_time([F.col(c) for c in seed_cols], F.col(ts_col), "syslog").alias("rowkey"),
        F.col("host").alias("fire_host"),
        F.col("vendor"),
        F.col("fire_type"),
        F.col("log_type"),
        severity(F.col("pri")).alias("severity"),
        facility(F.col("pri")).alias("facility"),
    ] + [_renamed(t).alias(t) for t in target_fields()] + [
        F.map_filter(F.col("detail"),
                     lambda k, v: ~F.coalesce(F.array_contains(mapped_cases, k), F.lit(False))).alias("extras"),
        F.col(ts_col).alias("event_time"),
    ])


def normalise(classified: DataFrame, ts_col: str = "timestamp",
              seed_cols: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """Accepted rows in the normalised firewall schema: every model target (default ''),
    ``extras`` for keys with no mapping, plus rowkey, host, type tags, severity, facility."""
    return classified.filter(F.col("accepted")).select(*_normalised_columns(ts_col, tuple(seed_cols)))


def quarantine(classified: DataFrame) -> DataFrame:
    """Rejected rows with their reason (accepted + quarantined = input)."""
    return classified.filter(~F.col("accepted")).select(
        "value", "data", "host", "vendor", "log_type", "reason", "timestamp")


def to_topic_records(normalised: DataFrame) -> DataFrame:
    """SNK-01: one JSON value per normalised record."""
    return normalised.select(F.col("rowkey").alias("key"),
                             F.to_json(F.struct(*[c for c in normalised.columns])).alias("value"))


# --- AGG-01 .. AGG-07, AGG-11 ------------------------------------------------------------

def vendor_device_counts(classified: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """AGG-01 / AGG-11: per (vendor, device ip): origin, black, first and last seen."""
    return (classified.filter(F.col("vendor").isNotNull())
            .groupBy("vendor", F.col("host").alias("device_ip"))
            .agg(F.count(F.lit(1)).alias("origin_count"),
                 F.sum("black").cast("long").alias("black_count"),
                 F.min(ts_col).alias("first_seen"),
                 F.max(ts_col).alias("last_seen")))


def vendor_daily_counts(classified: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """AGG-02 / AGG-04 (+ accepted): per vendor and day."""
    return (classified.filter(F.col("vendor").isNotNull())
            .groupBy("vendor", F.to_date(ts_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("origin_count"),
                 F.sum("black").cast("long").alias("black_count"),
                 F.sum(F.col("accepted").cast("int")).cast("long").alias("accepted_count")))


def vendor_lifetime_counts(classified: DataFrame) -> DataFrame:
    """AGG-03 / AGG-05."""
    return (classified.filter(F.col("vendor").isNotNull()).groupBy("vendor")
            .agg(F.count(F.lit(1)).alias("origin_count"),
                 F.sum("black").cast("long").alias("black_count")))


def firewall_totals(classified: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """AGG-06 / AGG-07: every message counts as origin (even unparsed); daily rows plus one
    lifetime row (``day`` NULL) from a single ``rollup``."""
    return (classified.rollup(F.to_date(ts_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("origin_count"),
                 F.sum("black").cast("long").alias("black_count")))


def reason_counts(classified: DataFrame) -> DataFrame:
    return (classified.groupBy(F.coalesce("vendor", F.lit("")).alias("vendor"),
                               F.coalesce("reason", F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def run(topic: DataFrame) -> DataFrame:
    """Envelope -> classified frame (the shared input of every firewall output)."""
    return classify(decode_envelope(topic))

