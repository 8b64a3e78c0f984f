"""String, JSON and key functions as ``Column`` expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- regex helpers ----------------------------------------------------------------------

def java_regex(pattern: str) -> str:
    """Python named groups ``(?P<x>`` -> Java ``(?<x>``; everything else is shared syntax."""
    return pattern.replace("(?P<", "(?<")


def group_index(pattern: str, name: str) -> int:
    """Capture-group number of a named group (same numbering in Java and Python)."""
    return re.compile(pattern).groupindex[name]


def group_names(pattern: str) -> list[str]:
    gi = re.compile(pattern).groupindex
    return sorted(gi, key=gi.get)


def anchored(pattern: str) -> str:
    """``re.match`` semantics: anchored at the start, not at the end."""
    return "^(?:" + java_regex(pattern) + ")"


def match_start(s, pattern: str) -> Column:
    return F.coalesce(_c(s).rlike(anchored(pattern)), F.lit(False))


GROUP_SEP = "\u0001"


def extract_groups(s, pattern: str, names: list[str]) -> Column:
    """All named groups of one anchored match in a single regex pass: the match (plus the
    rest of the text) is replaced by the groups joined with U+0001, then split; that character is taken out of
    the text first.  Only meaningful where the pattern is known to match (guard with ``match_start``)."""
    repl = GROUP_SEP.join("$" + str(group_index(pattern, n)) for n in names)
    joined = F.regexp_replace(F.translate(_c(s), GROUP_SEP, ""), anchored(pattern) + "(?s:.*)$", repl)
    return F.split(joined, GROUP_SEP, -1)


def extract_named(s, pattern: str, name: str) -> Column:
    """Value of a named group of an anchored match (SCL-02); '' when the group did not take part."""
    return F.regexp_extract(_c(s), anchored(pattern), group_index(pattern, name))


# --- tokenisers ---------------------------------------------------------------------------

def kv_tokens(s) -> Column:
    """``k=v`` tokeniser (SCL-01): split on single spaces, split each token on its first '=';
    a token without '=' maps to itself; quotes are kept; the last duplicate wins (the
    session's ``mapKeyDedupPolicy=LAST_WIN``)."""
    toks = F.split(_c(s), " ")
    entries = F.transform(toks, lambda t: F.struct(
        F.split(t, "=", 2).getItem(0).alias("key"),
        F.element_at(F.split(t, "=", 2), -1).alias("value")))
    return F.map_from_entries(entries)


def percent_decode(s) -> Column:
    """Percent-decoding that keeps '+' as '+' (SCL-06); invalid input -> input unchanged."""
    x = _c(s)
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def url_authority(url) -> Column:
    """Network location of a URL (SCL-07): what follows ``scheme://`` up to the next '/',
    '?' or '#', userinfo and port included; '' without a scheme.  A regex rather than
    ``parse_url``, which rejects URLs with unescaped characters such as spaces."""
    return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def malware_category(name) -> Column:
    """Category of ``category[behaviour]/family``: text before '/' and before '[' (SCL-08)."""
    head = F.split_part(F.coalesce(_c(name), F.lit("")), F.lit("/"), F.lit(1))
    return F.split_part(head, F.lit("["), F.lit(1))


def malware_behaviour(name) -> Column:
    """Text of the first ``[...]`` group of the part before '/', '' when absent (SCL-08)."""
    head = F.split_part(F.coalesce(_c(name), F.lit("")), F.lit("/"), F.lit(1))
    return F.regexp_extract(head, r"\[(.*?)\]", 1)


# FIXED VALUES: path patterns of command lines, by the operating system of the asset
WINDOWS_PATHS = r"((?:[A-Za-z]:(?:\\[^\\/<>|*?]+)+)+)"
UNIX_PATHS = r"^(\s*[/|.](?:\S+)(?:/\S+)+)"


def windows_paths(cmd) -> Column:
    """Windows paths in a command line (SCL-09): a drive and its segments; a segment runs on
    over spaces and quotes up to a character that no path has."""
    return F.regexp_extract_all(_c(cmd), F.lit(WINDOWS_PATHS), 1)


def unix_paths(cmd) -> Column:
    """The path at the start of a command line, if it begins with one of several segments."""
    return F.regexp_extract_all(_c(cmd), F.lit(UNIX_PATHS), 1)


def command_paths(cmd, os_name) -> Column:
    """SCL-09: by the asset's operating system, Windows paths or the leading Unix path."""
    return F.when(F.upper(F.coalesce(_c(os_name), F.lit(""))).contains("WIN"), windows_paths(cmd)).otherwise(unix_paths(cmd))


def file_name_from_path(p) -> Column:
    """Last segment after a backslash (SCL-10)."""
    return F.element_at(F.split(_c(p), r"\\"), -1)


def hash4(*cols) -> Column:
    """Four hex characters of md5 over the inputs: deterministic replacement of a random
    row-key prefix (Q1)."""
    return F.substring(F.md5(F.concat_ws("\u0001", *[_c(c).cast("string") for c in cols])), 1, 4)


def rowkey_offset(topic, partition, offset) -> Column:
    """``hash4 + zero-padded offset`` (SCL-11)."""
    return F.concat(hash4(topic, partition, offset), F.lpad(_c(offset).cast("string"), 12, "0"))


def rowkey_time(seeds, ts, suffix: str) -> Column:
    """``hash4 _ reversed yyyyMMddHHmmss _ suffix`` (SCL-12); ``seeds`` are the columns
    identifying the message (topic, partition, offset)."""
    return F.concat_ws("_", hash4(*seeds), F.reverse(F.date_format(_c(ts), "yyyyMMddHHmmss")),
                       F.lit(suffix))


def rowkey_md5_mid(s) -> Column:
    """Middle 16 hex characters of md5 (SCL-13)."""
    return F.substring(F.md5(_c(s).cast("string")), 9, 16)


def dotted_part(s, i: int) -> Column:
    """1-based part of a dot-separated label (SCL-16); NULL when absent."""
    return F.get(F.split(_c(s), r"\."), i - 1)


def split_trim_first_space(s, sep: str = ",") -> Column:
    """Split on ``sep`` and drop one leading space from each part (SCL-17)."""
    return F.transform(F.split(_c(s), re.escape(sep)),
                       lambda x: F.when(x.startswith(" "), F.substring(x, 2, F.length(x))).otherwise(x))


def cve_ids(refs) -> Column:
    """From ``["cve,NNNN", "url,..."]`` keep the ids of ``cve`` references (SCL-18)."""
    picked = F.filter(_c(refs), lambda r: F.split_part(r, F.lit(","), F.lit(1)) == "cve")
    return F.transform(picked, lambda r: F.split_part(r, F.lit(","), F.lit(2)))


def os_group(os_ver) -> Column:
    """OS grouping (SCL-19): ``Win…`` word, ``Ubuntu x.y``, ``CentOS`` + first number;
    anything else (or no match) -> NULL."""
    v = _c(os_ver)
    return (F.when(v.rlike("^Win"), F.regexp_substr(v, F.lit("^Win[0-9A-z]*")))
             .when(v.rlike("^Ubuntu"), F.regexp_substr(v, F.lit(r"^Ubuntu\s[0-9]*.[0-9]*")))
             .when(v.rlike("^CentOS"), F.concat(F.lit("CentOS"), F.regexp_substr(v, F.lit(r"\s[0-9]\d*")))))


def bytes_to_g(s) -> Column:
    """Bytes -> whole ``nG``; unparseable input kept as is (SCL-20)."""
    n = F.expr("try_cast(NULL AS BIGINT)") if s is None else _c(s).try_cast("bigint")
    return F.coalesce(F.concat((n / F.lit(1 << 30)).cast("bigint").cast("string"), F.lit("G")),
                      _c(s))


def service_path(p) -> Column:
    """Drop quotes, keep the first space-separated token, trim (SCL-21)."""
    return F.trim(F.split_part(F.replace(_c(p), F.lit('"'), F.lit("")), F.lit(" "), F.lit(1)))


# FIXED VALUES: the headers that are kept of a request or response
CARRIER_HEADERS = ("Host", "Connection", "User-Agent", "Accept", "Referer", "Accept-Encoding", "Accept-Language", "Cookie",
                   "Contern-Type", "Version")


def header_map(entries) -> Column:
    """``[{key,value}, ...]`` -> map of the kept headers, stopping at the first empty entry, i.e. one
    that is null or has neither key nor value fields (SCL-25); an entry of empty strings doesn't
    end it."""
    arr = _c(entries)
    empties = F.array_position(F.transform(arr, lambda e: e.isNull() | (e["key"].isNull() & e["value"].isNull())),
                               F.lit(True))
    kept = F.filter(F.when(empties > 0, F.slice(arr, 1, empties - 1)).otherwise(arr), lambda e: e["key"].isin(*CARRIER_HEADERS))
    return F.map_from_entries(F.transform(F.coalesce(kept, F.array()),
                                          lambda e: F.struct(e["key"], e["value"])))


def hex_to_text(s) -> Column:
    """``0x...`` hex string -> UTF-8 text; others unchanged (SCL-23)."""
    x = _c(s)
    return F.when(x.contains("0x"),
                  F.coalesce(F.expr("NULL").cast("string"),
                             F.decode(F.try_to_binary(F.substring(x, 3, F.length(x)), F.lit("hex")),
                                      "UTF-8"))).otherwise(x)


def empty_if_null(c) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def first_or_empty(arr) -> Column:
    """Head of a list or '' (SCL-24)."""
    return F.coalesce(F.get(_c(arr), 0), F.lit(""))


def truthy(c) -> Column:
    """Explicit truthiness: NULL / '' / 0 / false -> false."""
    x = _c(c).cast("string")
    return F.coalesce(~F.lower(x).isin("", "0", "false", "none", "null", "[]"), F.lit(False))


def parse_syslog_line(line) -> Column:
    """SCL-29: plain syslog text -> struct(PRI, HEADER, PID, OWNER, MSG); NULL when the line
    does not match.  Severity comes from the bracketed level (brackets stripped -- the
    evident intent), an emergency owner overrides it; PRI = facility * 8 + severity."""
    from .. import config as C

    p = C.SYSLOG_LINE_PATTERN
    names = ["time", "host", "owner", "pid", "level", "msg"]
    g = extract_groups(line, p, names)
    level = F.regexp_replace(g[4], r"[\[\]]", "")
    sev = F.lit(C.SYSLOG_DEFAULT_SEVERITY)
    for k, v in reversed(list(C.SYSLOG_LEVEL_SEVERITY.items())):
        sev = F.when(level == k, F.lit(v)).otherwise(sev)
    sev = F.when(g[2].isin(*C.SYSLOG_EMERGENCY_OWNERS), F.lit(0)).otherwise(sev)
    st = F.struct((F.lit(C.SYSLOG_USER_FACILITY * 8) + sev).cast("string").alias("PRI"),
                  F.concat_ws(" ", g[0], g[1]).alias("HEADER"), g[3].alias("PID"),
                  g[2].alias("OWNER"), g[5].alias("MSG"))
    return F.when(match_start(line, p), st)
