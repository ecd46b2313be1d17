"""Diagnostics of one text: issues with positions, and the renderer's likely message for a reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dialect as D
from ..functions.text import positions, unescaped_dollars

ORPHANS = (("eta", D.SPOILT["eta"], "\\beta"), ("rac", D.SPOILT["rac"], "\\frac"), ("ext", D.SPOILT["ext"], "\\text"), ("alphaeta", r"(?U)(?<![\\A-Za-z])alphaeta" + D.WORD_END, "\\alpha\\beta"))


def _issues(kind: str, c: Column, pattern: str, suggested: str | None = None) -> Column:
    own = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.zip_with(positions(c, pattern), own, lambda p, m: F.struct(F.lit(kind).alias("kind"), p.alias("position"), m.alias("found"), F.lit(suggested).cast("string").alias("suggested")))


def _marks(c: Column) -> Column:
    """combining_diacritic issues; found names the code point."""
    found = F.transform(_issues("combining_diacritic", c, D.COMBINING), lambda s: s.withField("found", F.format_string("U+%04X", F.ascii(s["found"]))))
    return found


def brace_issues(c: Column) -> Column:
    """extra_closing_brace where the stack is empty, then missing_closing_brace for each opening left."""
    masked = F.regexp_replace(c, r"(?s)\\.", "  ")
    spots = F.transform(F.split(masked, ""), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    spots = F.filter(spots, lambda s: s["x"].isin("{", "}"))
    none = F.array().cast("array<int>")
    step = lambda a, s: F.when(s["x"] == "{", F.struct(F.array_append(a["open"], s["i"]).alias("open"), a["extra"].alias("extra"))).when(F.size(a["open"]) > 0, F.struct(F.slice(a["open"], F.lit(1), F.size(a["open"]) - 1).alias("open"), a["extra"].alias("extra"))).otherwise(F.struct(a["open"].alias("open"), F.array_append(a["extra"], s["i"]).alias("extra")))
    walked = F.aggregate(spots, F.struct(none.alias("open"), none.alias("extra")), step)
    made = lambda xs, kind, found: F.transform(xs, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("position"), F.lit(found).alias("found"), F.lit("}" if found == "{" else None).cast("string").alias("suggested")))
    return F.concat(made(walked["extra"], "extra_closing_brace", "}"), made(walked["open"], "missing_closing_brace", "{"))


def issues(c: Column) -> Column:
    """All issues (kind, position, found, suggested) of a text; a null text has none."""
    c = F.coalesce(c, F.lit(""))
    masked = F.regexp_replace(c, r"(?s)\\.", "  ")
    last = F.length(c) - F.locate("$", F.reverse(masked))
    dollar = F.when(unescaped_dollars(c) % 2 == 1, F.array(F.struct(F.lit("unbalanced_dollar").alias("kind"), last.cast("int").alias("position"), F.lit("$").alias("found"), F.lit("$").alias("suggested")))).otherwise(F.array().cast("array<struct<kind:string,position:int,found:string,suggested:string>>"))
    orphans = [_issues(f"orphan_{n}", c, p, s) for n, p, s in ORPHANS]
    return F.concat(brace_issues(c), dollar, *orphans, _marks(c), _issues("fill_blank_subscript_run", c, "_{3,}"), _issues("forbidden_command", c, r"\\(?:" + "|".join(D.DIAGNOSED) + r")\b"))


def context(c: Column, position: Column, width: int = 28) -> Column:
    """The text around a position, and a caret under it."""
    start = F.greatest(position - width, F.lit(0))
    return F.concat(F.replace(F.substring(c, start + 1, F.lit(2 * width)), F.lit("\n"), F.lit(" ")), F.lit("\n"), F.repeat(F.lit(" "), position - start), F.lit("^"))


def predicted_error(reason: Column) -> Column:
    """The message of the math renderer that a reason stands for."""
    return (
        F.when(reason == "html_content", "Unsupported character / would render as junk").when(reason.isin("unbalanced_brace_count", "unbalanced_close_brace"), "Expected '}' at end of input").when(reason == "subscript_run_too_long", "Expected group after '_'")
        .when(reason == "exceeds_max_length", "(would exceed KaTeX maxExpand — possible infinite loop)").when(reason == "brace_depth_exceeded", "(too deeply nested — KaTeX maxExpand limit)").when(reason == "empty_math_segment", "(empty math segment — KaTeX renders blank)")
        .when(reason.startswith("forbidden_command:"), F.concat(F.lit("Undefined control sequence: \\"), F.substring_index(reason, ":", -1))).otherwise(F.concat(F.lit("(maps to: "), reason, F.lit(")")))
    )
