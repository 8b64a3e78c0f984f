"""Personal data: regular expressions propose spans, checksums confirm them, nearby words score them.

Everything is DataFrame expressions, so a text never leaves the JVM.  A kind's spans come from
the pieces between the matches (``split``) and the matches themselves; running sums of their
lengths give positions in code points, end exclusive.

Base kinds, leftmost and without overlap within a kind: email; ip (parts at most 255); card (14
to 19 digits, Luhn); phone (10 to 15 digits).  A match that fails its test is dropped and not
tried again in a shorter form.  The method adds ``iban``: two letters, two digits and 11 to 30
letters or digits, together or in groups of four, confirmed by the remainder 1 modulo 97.

The patterns are written with possessive repeats and a look-behind, which change no match: Java
then neither recurses over long runs nor starts anew at each character of one.

A null or empty text has no spans.  Repeated rows are treated alike.  Columns of the input keep
their values; an output column of the same name as an input column replaces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")

_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
}
#: Cheap tests without which a pattern can't match or none of its matches can be valid.
_HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"\b[A-Z]{2}[0-9]{2}[\x20A-Z0-9]"),
}
#: Words near a span that speak for a kind, and the window in characters on either side.
CONTEXT = {
    "email": r"mail|contact|write|e-mail|address",
    "ip": r"\bip\b|host|server|address|login|client",
    "card": r"card|visa|master|credit|debit|payment|pay\b|amex",
    "phone": r"phone|call|tel\b|mobile|fax|cell|contact",
    "iban": r"iban|bank|account|transfer|swift|bic\b",
}
WINDOW = 40
#: Score of a span by kind: what the pattern and its checksum say alone; a context word adds 0.2.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.75, "phone": 0.6, "iban": 0.8}
_BLOCK = 512


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    def part(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 0, v).when(v >= 5, v * 2 - 9).otherwise(v * 2)
    values = F.transform(F.split(F.reverse(_digits(s)), ""), part)
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _mod97(s: Column) -> Column:
    flat = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 4))
    rest = F.aggregate(
        F.transform(F.split(turned, ""), F.ascii), F.lit(0),
        lambda acc, c: F.when(c >= 65, (acc * 100 + c - 55) % 97).when(c >= 48, (acc * 10 + c - 48) % 97).otherwise(acc))
    return F.length(flat).between(15, 34) & (rest == 1)


_VALID = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": lambda s: F.when(F.length(_digits(s)).between(14, 19), _luhn(s)).otherwise(False),
    "phone": lambda s: F.length(_digits(s)).between(10, 15),
    "iban": _mod97,
}


def _placed(blocks: Column) -> Column:
    """Blocks of (gap, value, near) with the start of each value.  Running sums go in two levels,
    so that a text with very many matches costs far less than their square."""
    width = lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["value"]))
    item = "struct<gap:int,value:string,near:string>"
    with_starts = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,block:array<{item}>>>").alias("out")),
        lambda acc, b: F.struct((acc["at"] + width(b)).alias("at"),
                                F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), b.alias("block")))).alias("out")))["out"]
    return F.flatten(F.transform(with_starts, lambda w: F.aggregate(
        w["block"],
        F.struct(w["at"].alias("at"), F.array().cast("array<struct<value:string,near:string,start:int>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["value"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(x["value"].alias("value"), x["near"].alias("near"), (acc["at"] + x["gap"]).alias("start")))).alias("out")))["out"]))


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the array ``spans`` of (start, rank, end, kind, value, score), in the order of
    start, then of the kinds as listed.  ``rank`` is the kind's place in ``KINDS``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_text", whole)
    d = d.withColumns({f"_hit_{k}": _HINTS[k](F.col("_text")) for k in KINDS})
    t = F.col("_text")
    none = F.array().cast("array<string>")
    d = d.withColumns({f"_m_{k}": F.when(F.col(f"_hit_{k}"), F.regexp_extract_all(t, F.lit(PATTERNS[k]), 0)).otherwise(none) for k in KINDS})
    d = d.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(t, PATTERNS[k], -1)).otherwise(none) for k in KINDS})

    # the text before and behind a match, up to the neighbours of its kind
    near = lambda before, behind: F.concat(F.right(before, F.lit(WINDOW)), F.lit(" "), F.left(behind, F.lit(WINDOW)))
    d = d.withColumns({f"_i_{k}": F.zip_with(
        F.zip_with(F.slice(F.col(f"_g_{k}"), 1, F.size(f"_m_{k}")), F.slice(F.col(f"_g_{k}"), 2, F.size(f"_m_{k}")),
                   lambda a, b: F.struct(F.length(a).alias("gap"), near(a, b).alias("near"))),
        F.col(f"_m_{k}"), lambda x, m: F.struct(x["gap"].alias("gap"), m.alias("value"), x["near"].alias("near"))) for k in KINDS})
    d = d.withColumns({f"_b_{k}": F.when(F.size(f"_m_{k}") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(f"_m_{k}") - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(F.col(f"_i_{k}"), b * _BLOCK + 1, F.lit(_BLOCK)))) for k in KINDS})  # noqa: B023

    def made(k: str, rank: int) -> Column:
        def one(x: Column) -> Column:
            score = F.lit(PRIOR[k]) + F.when(F.lower(x["near"]).rlike(CONTEXT[k]), 0.2).otherwise(0.0)
            return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), (x["start"] + F.length(x["value"])).alias("end"),
                            F.lit(k).alias("kind"), x["value"].alias("value"), F.round(score, 2).alias("score"))
        valid = F.filter(_placed(F.col(f"_b_{k}")), lambda x: _VALID[k](x["value"]))
        kind = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"
        return F.when(F.size(f"_m_{k}") > 0, F.transform(valid, one)).otherwise(F.array().cast(kind))

    d = d.withColumns({f"_s_{k}": made(k, i) for i, k in enumerate(KINDS)})
    d = d.withColumn(spans, F.array_sort(F.concat(*(F.col(f"_s_{k}") for k in KINDS))))
    return d.drop("_text", *(f"_{x}_{k}" for x in ("hit", "m", "g", "i", "b", "s") for k in KINDS))


def digest(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, text: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with every span of a score of at least ``least`` replaced by its kind in angle
    brackets; overlapping spans are replaced once, by the first one's kind.  A null text stays null."""
    d = find(docs, text, "_spans")
    d = d.withColumn("_spans", F.filter("_spans", lambda s: s["score"] >= least))
    t = F.col(text)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    parts = F.aggregate(
        "_spans", empty,
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        .otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(
            F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))))
    d = d.withColumn("_parts", F.when(F.size("_spans") > 0, parts))
    tail = F.substring(t, F.col("_parts.at") + 1, F.length(t))
    new = F.when(F.col("_parts").isNotNull(), F.concat(F.array_join("_parts.out", ""), tail)).otherwise(t)
    return d.withColumn(text, new).drop("_spans", "_parts")
