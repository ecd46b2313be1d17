"""Small text functions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dialect as D


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nfc(c: Column) -> Column:
    """Unicode NFC, by the ICU library that Spark ships; ASCII texts skip it."""
    composed = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(False))
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


MARKS = (("\u0003", "c"), ("\u0001", "a"), ("\u0002", "b"))


def unmarked(c: Column) -> Column:
    """c without U+0001 and U+0002, which mark cuts: they and U+0003 become U+0003 and a letter."""
    out = c
    for mark, letter in MARKS:
        out = F.replace(out, F.lit(mark), F.lit("\u0003" + letter))
    return F.when(c.rlike("[\u0001-\u0003]"), out).otherwise(c)


def remarked(c: Column) -> Column:
    """What unmarked() was given."""
    out = c
    for mark, letter in reversed(MARKS):
        out = F.replace(out, F.lit("\u0003" + letter), F.lit(mark))
    return F.when(c.contains("\u0003"), out).otherwise(c)


def unescaped_dollars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"(?s)\\.|[^$]", "")).cast("int")


def net_braces(c: Column) -> Column:
    """Opening less closing braces, escaped ones left out."""
    bare = F.regexp_replace(c, r"(?s)\\.", "")
    return F.length(F.regexp_replace(bare, r"[^{]", "")) - F.length(F.regexp_replace(bare, r"[^}]", ""))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def shortened(c: Column, most: int, keep: int, mark: str = "...") -> Column:
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, keep), F.lit(mark)))


def positions(c: Column, pattern: str) -> Column:
    """0-based code point offsets of all matches: running sums over what lies between and in them."""
    gaps, own = F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(own)), own, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(steps, start, lambda a, s: F.struct(F.array_append(a["out"], a["at"] + s["g"]).alias("out"), (a["at"] + s["g"] + s["m"]).alias("at")), lambda a: a["out"])


def family(path: Column) -> Column:
    """The source family of a field path; null, empty and unmatched paths are `unknown`."""
    out = None
    for parts, name in D.FAMILY_RULES:
        test = None
        for p in parts:
            test = path.contains(p) if test is None else test & path.contains(p)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("unknown")


def prior(name: Column, priors: dict[str, float] | None = None) -> Column:
    own = D.PRIORS | (priors or {})
    table = F.create_map(*[F.lit(x) for kv in own.items() for x in kv])
    return F.coalesce(F.element_at(table, name), F.lit(own["unknown"]))
