"""Plan-shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, barrier: bool = True, **cols: Column) -> DataFrame:
    """Add ``cols`` as a *binding*: they are evaluated once per row and later expressions refer
    to them as attributes.

    Plain ``withColumn`` chains get inlined by the optimizer when a later filter is pushed
    down through them, and a deep chain of multiply-referenced expressions (regex over the
    result of another regex) then grows exponentially.  Producing the columns through a
    one-element ``inline`` (a ``Generate`` node, still whole-stage code generated) keeps
    them as attributes: neither ``CollapseProject`` nor predicate push-down substitute
    generator output.

    ``barrier=False`` is a plain ``withColumns`` (cheaper to run) for stages whose
    expressions are shallow and never sit under a pushed-down filter.
    """
    if not barrier:
        return df.withColumns(cols)
    st = F.struct(*[c.alias(n) for n, c in cols.items()])
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(st)))



SIEVE_BITS = 26   # a sieve is 8 MB at most, whatever the tables' size


def sieved(rows: DataFrame, of: Column, side: DataFrame, side_of: Column, inside: bool = True) -> DataFrame:
    """The ``rows`` that may have the same 64-bit hash (``of``) as a row of ``side`` (``side_of``), or those that surely
    have not.  The two parts have each row once.

    A bitmap of fixed size in pieces of 32,768 bits is broadcast and nothing shuffled but the hashes of ``side``.  More of ``side``
    lets more rows pass, none is lost; the join or aggregate that follows decides.  A semi or anti join is pushed below
    projections, so that what it drops isn't worked out."""
    place = lambda h: F.pmod(h, F.lit(1 << SIEVE_BITS))
    pieces = (side.select(place(side_of).alias("_at")).groupBy(F.shiftright("_at", 15).alias("_piece"))
              .agg(F.bitmap_construct_agg(F.col("_at").bitwiseAND(32767)).alias("_bits")))
    at = place(of).bitwiseAND(32767)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    held = F.shiftright(place(of), 15) == F.col("_piece")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    return rows.join(F.broadcast(pieces), held & bit, "left_semi" if inside else "left_anti")
