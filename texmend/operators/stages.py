"""The stages of healing one text: tokens, signals, repairs, validation. All are Column to Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dialect as D
from ..functions.text import net_braces, remarked, strip, unescaped_dollars, unmarked

OPENERS = (("$$", "math_display"), ("$", "math_inline"), ("\\(", "math_paren"), ("\\[", "math_bracket"))


def names(*found: tuple[Column, str]) -> Column:
    """The names whose test holds, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in found)))


def tokenize(c: Column) -> Column:
    """Segments (kind, content, start, end): text and math by leftmost delimiters; blank math is text and joins its neighbours."""
    marked = F.replace(F.regexp_replace(unmarked(c), D.TOKENS, "\u0001$2\u0002$1$3"), F.lit("\u0001\u0002"), F.lit(""))
    parts = F.transform(F.split(marked, "[\u0001\u0002]", -1), remarked)
    step = lambda a, p: F.struct(F.array_append(a["out"], F.struct((a["n"] % 2 == 1).alias("math"), p.alias("whole"), a["at"].alias("start"), (a["at"] + F.length(p)).alias("end"))).alias("out"), (a["n"] + 1).alias("n"), (a["at"] + F.length(p)).alias("at"))
    start = F.struct(F.array().cast("array<struct<math:boolean,whole:string,start:int,end:int>>").alias("out"), F.lit(0).alias("n"), F.lit(0).alias("at"))
    pieces = F.filter(F.aggregate(parts, start, step, lambda a: a["out"]), lambda p: p["whole"] != "")
    kind = lambda p: F.when(~p["math"], "text").when(p["whole"].startswith("$$"), "math_display").when(p["whole"].startswith("$"), "math_inline").when(p["whole"].startswith("\\("), "math_paren").otherwise("math_bracket")
    width = lambda p: F.when(~p["math"], 0).when(p["whole"].startswith("$") & ~p["whole"].startswith("$$"), 1).otherwise(2)
    return F.transform(pieces, lambda p: F.struct(kind(p).alias("kind"), F.substring(p["whole"], width(p) + 1, F.length(p["whole"]) - 2 * width(p)).alias("content"), p["start"].alias("start"), p["end"].alias("end")))


def delimited(kind: Column, c: Column) -> Column:
    return F.when(kind == "math_display", F.concat(F.lit("$$"), c, F.lit("$$"))).when(kind == "math_paren", F.concat(F.lit("\\("), c, F.lit("\\)"))).when(kind == "math_bracket", F.concat(F.lit("\\["), c, F.lit("\\]"))).otherwise(F.concat(F.lit("$"), c, F.lit("$")))


def signals(c: Column, inside: bool) -> Column:
    """The evidence for math in a segment, a fixed struct."""
    commands = F.size(F.filter(F.regexp_extract_all(c, F.lit(r"\\([a-zA-Z]+)"), F.lit(1)), lambda x: x.isin(*sorted(D.VOCABULARY))))
    count = lambda p: F.regexp_count(c, F.lit(p))
    outside = F.lit(not inside)
    return F.struct(
        commands.alias("known_commands"), count(D.SUPER).alias("super"), count(D.SUB).alias("sub"), count(r"[+\-*/=<>^_]").alias("operators"), count(r"(?U)\d").alias("digits"), c.rlike(D.HTML_ROUTE).alias("html"),
        (outside & c.rlike("_{3,}")).alias("fill_blank"), (outside & c.rlike(D.CURRENCY)).alias("currency"), (outside & strip(c).rlike("^[A-Za-z]{1,15}$")).alias("pure_alpha_token"), names(*((c.rlike(p), n) for n, p in D.SPOILT.items())).alias("corruption"),
    )


def score(s: Column, prior: Column, inside: bool, boost: float = 0.6, weight: float = 0.15) -> Column:
    """The intent score in [0, 1]; of currency it may only not be negative."""
    raw = (
        F.lit(boost if inside else 0.0) + prior * weight + F.least(F.lit(0.35), s["known_commands"] * 0.12) + F.least(F.lit(0.15), (s["super"] + s["sub"]) * 0.05) + F.when((s["operators"] >= 2) & (s["digits"] >= 1), 0.1).otherwise(0.0)
        + F.when(s["currency"], -0.6).otherwise(0.0) + F.when(s["pure_alpha_token"], -0.4).otherwise(0.0) + F.when(F.size(s["corruption"]) > 0, 0.15).otherwise(0.0)
    )
    return F.when(s["html"] | s["fill_blank"], 0.0).when(s["currency"], F.greatest(F.lit(0.0), raw)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))


def wrap(c: Column, prior: Column, threshold: float = 0.5) -> Column:
    """(text, name): bare math of a likely family gets dollars; one dollar at either end gives way."""
    s = strip(c)
    dollars = unescaped_dollars(s)
    lead = (dollars == 1) & s.startswith("$")
    trail = (dollars == 1) & ~lead & s.endswith("$")
    body = F.when(lead, F.regexp_replace(F.substring(s, F.lit(2), F.length(s)), r"(?U)^\s+", "")).when(trail, F.regexp_replace(F.substring(s, F.lit(1), F.length(s) - 1), r"(?U)\s+$", "")).otherwise(s)
    mathy = body.rlike(D.any_command()) | body.rlike(D.SUP_SUB) | body.rlike(r"\\\{|\\\}")
    ok = (prior >= threshold) & ~s.contains("\\(") & ~s.contains("\\[") & ((dollars == 0) | lead | trail) & body.rlike(D.MATH_ONLY) & mathy
    wrapped = F.concat(F.regexp_extract(c, r"(?U)^\s*", 0), F.lit("$"), body, F.lit("$"), F.regexp_extract(c, r"(?U)\s*$", 0))
    return F.struct(F.when(ok, wrapped).otherwise(c).alias("text"), F.when(ok, F.when(dollars == 1, "wrap_math_only_strip_orphan_dollar").otherwise("wrap_math_only")).alias("name"))


def literal_escapes(c: Column) -> Column:
    c = F.regexp_replace(c, D.ESCAPED_NEWLINE, "\n")
    c = F.regexp_replace(c, D.ESCAPED_TAB, "\t")
    return F.regexp_replace(c, D.ESCAPED_RETURN, "\r")


def diacritics(c: Column) -> Column:
    return F.regexp_replace(c, D.COMBINING, "")


def fill_blanks(c: Column) -> Column:
    r"""The first run of three or more underscores in each \text{} becomes a rule of at most 6 em."""
    for k in (3, 4, 5):
        c = F.regexp_replace(c, D.TEXT_BLANK + r"_{%d}(?!_)([^{}]*)\}" % k, r"\\text{$1\\rule{%dem}{0.4pt}$2}" % k)
    return F.regexp_replace(c, D.TEXT_BLANK + r"_{6,}([^{}]*)\}", r"\\text{$1\\rule{6em}{0.4pt}$2}")


def lost_frac(c: Column) -> Column:
    s = strip(c)
    num, den = F.regexp_extract(s, D.LOST_FRAC, 1), F.regexp_extract(s, D.LOST_FRAC, 2)
    new = F.concat(F.lit("\\frac{"), num, F.lit("}{"), den, F.lit("}"))
    clear = ~(F.replace(num, F.lit("\\}"), F.lit("")).contains("}") & ~F.replace(num, F.lit("\\{"), F.lit("")).contains("{"))
    return F.when((net_braces(c) < 0) & s.rlike(D.LOST_FRAC) & clear & (net_braces(new) == 0), new).otherwise(c)


#: Repairs of math in order.
MATH_REPAIRS: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("repair_alphaeta", lambda c: F.regexp_replace(c, D.ALPHAETA, r"\\alpha\\beta")),
    ("repair_orphan_eta_to_beta", lambda c: F.regexp_replace(c, D.ORPHAN_ETA, r"\\beta")),
    ("repair_orphan_greek", lambda c: F.regexp_replace(c, D.ORPHAN_GREEK, r"\\$1")),
    ("repair_orphan_rac", lambda c: F.regexp_replace(c, D.ORPHAN_RAC, r"\\frac$1")),
    ("repair_orphan_ext", lambda c: F.regexp_replace(c, D.ORPHAN_EXT, r"\\text$1")),
    ("repair_fill_blank_in_text", fill_blanks),
    ("repair_missing_frac_prefix", lost_frac),
)


def braces(c: Column) -> Column:
    """(negative, depth, deepest) of a walk over unescaped braces that stops at the first surplus closing one."""
    chars = F.filter(F.split(F.regexp_replace(c, r"(?s)\\.|[^{}]", ""), ""), lambda x: x != "")
    start = F.struct(F.lit(False).alias("negative"), F.lit(0).alias("depth"), F.lit(0).alias("deepest"))
    depth = lambda a, x: a["depth"] + F.when(x == "{", 1).otherwise(-1)
    return F.aggregate(chars, start, lambda a, x: F.when(a["negative"], a).otherwise(F.struct((depth(a, x) < 0).alias("negative"), depth(a, x).alias("depth"), F.greatest(a["deepest"], depth(a, x)).alias("deepest"))))


def reasons(c: Column, longest: int = 8000, deepest: int = 32, forbidden: tuple[str, ...] = D.FORBIDDEN) -> Column:
    """All reasons against a segment, in order."""
    b = braces(c)
    bad = F.regexp_extract(c, r"\\(" + "|".join(forbidden) + r")(?![a-zA-Z])", 1)
    listed = names((strip(c) == "", "empty_math_segment"), (F.length(c) > longest, "exceeds_max_length"), (b["negative"], "unbalanced_close_brace"), (~b["negative"] & (b["depth"] != 0), "unbalanced_brace_count"), (b["deepest"] > deepest, "brace_depth_exceeded"), (c.rlike("_{3,}"), "subscript_run_too_long"))
    return F.concat(listed, F.array_compact(F.array(F.when(bad != "", F.concat(F.lit("forbidden_command:"), bad)))))
