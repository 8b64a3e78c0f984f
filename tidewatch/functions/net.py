"""Address functions as pure ``Column`` expressions (no Python UDF, stays in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PRIVATE_BLOCKS

_U32 = 0xFFFFFFFF
_IPV4_RE = r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
_MAC_DASH_RE = r"^[0-9A-Fa-f]{2}(-[0-9A-Fa-f]{2}){5}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ip_to_long(ip) -> Column:
    """Dotted IPv4 -> unsigned 32-bit value as LONG.  Wrong number of parts -> 0 (SCL-03);
    a non-numeric part -> NULL."""
    parts = F.split(_c(ip), r"\.")
    folded = F.aggregate(parts, F.lit(0).cast("long"),
                         lambda acc, x: acc * F.lit(256) + x.cast("long"))
    return F.when(_c(ip).isNull(), F.lit(None).cast("long")) \
            .when(F.size(parts) != 4, F.lit(0).cast("long")) \
            .otherwise(folded)


def ip_literal_to_long(ip: str) -> int:
    a, b, c, d = (int(x) for x in ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def mask_bounds(ip, mask) -> tuple[Column, Column]:
    """(first, last) address of ``ip``/``mask`` (SCL-04), both LONG."""
    ipv, mv = ip_to_long(ip), ip_to_long(mask)
    lo = ipv.bitwiseAND(mv)
    hi = lo.bitwiseOR(F.lit(_U32) - mv)
    return lo, hi


def is_private(ip) -> Column:
    """127/8, 192.168/16, 172.16/12, 10/8 (FLT-16).  NULL/empty/malformed -> false."""
    v = ip_to_long(ip)
    conds = []
    for base, bits in PRIVATE_BLOCKS:
        m = (_U32 << (32 - bits)) & _U32
        conds.append(v.bitwiseAND(F.lit(m)) == F.lit(ip_literal_to_long(base)))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return F.coalesce(is_valid_ipv4(ip) & out, F.lit(False))


def in_range(ip, lo: str, hi: str) -> Column:
    """Inclusive range test on parameterised bounds (FLT-17)."""
    return F.coalesce(ip_to_long(ip).between(ip_literal_to_long(lo), ip_literal_to_long(hi)),
                      F.lit(False))


def is_valid_ipv4(ip) -> Column:
    """Dotted quad, every part 0-255 (SCL-30, FLT-20)."""
    return F.coalesce(_c(ip).rlike(_IPV4_RE), F.lit(False))


def is_dash_mac(mac) -> Column:
    return F.coalesce(_c(mac).rlike(_MAC_DASH_RE), F.lit(False))


def normalise_mac(mac) -> Column:
    """Upper-case and put a dash every two characters counted from the right (SCL-05)."""
    return F.regexp_replace(F.upper(_c(mac)), r"(?<=\w)(?=(?:\w\w)+$)", "-")


def cidr_cover(lo, hi) -> Column:
    """The fewest aligned blocks that make up the addresses ``lo`` to ``hi``: an array of
    struct(bits, block), where an address ``v`` is in a block if ``v >> bits = block``.

    On each level, a block is in the cover if its parent isn't inside the range: the first whole
    block if it is an odd one, and the last one if the next is odd."""
    lo, hi = _c(lo), _c(hi)

    def level(bits: Column) -> Column:
        size = F.pow(F.lit(2), bits).cast("long")
        first = F.floor((lo + size - 1) / size).cast("long")
        after = F.floor((hi + 1) / size).cast("long")
        left = (first < after) & (first % 2 == 1)
        right = (first < after) & (after % 2 == 1) & ~(left & (after - 1 == first))
        block = lambda b: F.struct(bits.alias("bits"), b.alias("block"))
        return F.filter(F.array(F.when(left, block(first)), F.when(right, block(after - 1))), lambda x: x.isNotNull())
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(32)), level))


def cidr_probes(v) -> Column:
    """The blocks of every size that hold address ``v``: an array of struct(bits, block)."""
    return F.transform(F.sequence(F.lit(0), F.lit(32)), lambda bits: F.struct(
        bits.alias("bits"), F.floor(_c(v) / F.pow(F.lit(2), bits)).cast("long").alias("block")))
