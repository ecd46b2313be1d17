"""A template corpus over the driver's tables: rows keyed by id whose healed results are known in advance."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

P = "assignment_question.body.rubric_steps[0].criterion"  # likely math
Q = "graded_item.feedback.text"
#: raw, field_path, family, prepared, outcome, buckets, repairs, reasons, segments, text kind counts; {n} is the row's id.
T: tuple[tuple[str | None, str | None, str, str, str, str, str, str, int], ...] = (
    ("\\alpha + \\beta = -\\frac{{n}}{6}", P, "rubric_criterion", "$\\alpha + \\beta = -\\frac{{n}}{6}$", "math", "A", "wrap_math_only", "", 1),
    ("$\\alpha + eta + \\alpha\\beta_{n}$", Q, "feedback", "$\\alpha + \\beta + \\alpha\\beta_{n}$", "math", "D", "repair_orphan_eta_to_beta", "", 1),
    ("$\\frac{1}{{n}} \\times rac{2}{5}$", Q, "feedback", "$\\frac{1}{{n}} \\times \\frac{2}{5}$", "math", "D", "repair_orphan_rac", "", 1),
    ("so $alphaeta = {n}$", Q, "feedback", "so $\\alpha\\beta = {n}$", "math", "D|G", "repair_alphaeta", "", 2),
    ("\\alpha = -\\frac{{n}}{6}$", P, "rubric_criterion", "$\\alpha = -\\frac{{n}}{6}$", "math", "A", "wrap_math_only_strip_orphan_dollar", "", 1),
    ("Cost: ${n} only.", Q, "feedback", "Cost: ${n} only.", "text", "C|J", "", "", 1),
    ("First line {n}\\nSecond line", Q, "feedback", "First line {n}\nSecond line", "text", "L", "literal_escape_to_whitespace", "", 1),
    ("$\\input{/etc/passwd{n}}$", Q, "feedback", "$\\input{/etc/passwd{n}}$", "fallback", "E", "", "forbidden_command:input", 1),
    ("plain words {n}", None, "unknown", "plain words {n}", "text", "Z", "", "", 1),
    ("", "", "unknown", "", "text", "Z", "", "", 0),
    (None, Q, "feedback", "", "text", "Z", "", "", 0),
    ("Let $x^{n}$ and $$y_{n}$$ hold", "x.student_answer", "student_answer", "Let $x^{n}$ and $$y_{n}$$ hold", "math", "G", "", "", 5),
    ("$x ____ {n}$", Q, "feedback", "$x ____ {n}$", "fallback", "H", "", "subscript_run_too_long", 1),
    ("$\\alpha^2 + \\text{a ______ b} = {n}$", P, "rubric_criterion", "$\\alpha^2 + \\text{a \\rule{6em}{0.4pt} b} = {n}$", "math", "Z", "repair_fill_blank_in_text", "", 1),
    ("$\\alpha^2 {n}}{3}$", P, "rubric_criterion", "$\\frac{\\alpha^2 {n}}{3}$", "math", "Z", "repair_missing_frac_prefix", "", 1),
    ("$\\frac{1}{{n}$", Q, "feedback", "$\\frac{1}{{n}$", "fallback", "B", "", "unbalanced_brace_count", 1),
    ("<p>Solve $x_{n}$ now</p>", Q, "feedback", "<p>Solve $x_{n}$ now</p>", "math", "F|G", "", "", 5),
    ("empty $$ $$ and \\(z={n}\\)", "x.options[1]", "authored_question", "empty $$ $$ and \\(z={n}\\)", "math", "G", "", "", 2),
    ("run `code {n}` here", "a.ai_answer", "ai_answer", "run `code {n}` here", "text", "I", "", "", 1),
    ("$\\text{\\sqrt{n}}+\\theta$", Q, "feedback", "$\\text{\\sqrt{n}}+\\theta$", "math", "K", "", "", 1),
    ("price \\${n} and \\[a<b_{n}\\]", "review_render.working_lines[0]", "review_working_line", "price \\${n} and \\[a<b_{n}\\]", "math", "G", "", "", 2),
    ("$lambda = \\mu^{n}$", P, "rubric_criterion", "$\\lambda = \\mu^{n}$", "math", "D", "repair_orphan_greek", "", 1),
    ("$ext{cm}^{n} = \\pi$", P, "rubric_criterion", "$\\text{cm}^{n} = \\pi$", "math", "D", "repair_orphan_ext", "", 1),
)
#: More templates: a REP1 and a REP2 case, braces too deep or surplus, unknown tags, marks that the engine uses itself, a literal line break.
T += (
    ("cafe\u0301 {n}", Q, "feedback", "caf\u00e9 {n}", "text", "Z", "nfc_normalize", "", 1),
    ("$x\u0303 = {n}$", Q, "feedback", "$x = {n}$", "math", "D", "strip_combining_diacritics", "", 1),
    ("$" + "{" * 33 + "{n}" + "}" * 33 + "$", Q, "feedback", "$" + "{" * 33 + "{n}" + "}" * 33 + "$", "fallback", "B", "", "brace_depth_exceeded", 1),
    ("$x}{n}{$", Q, "feedback", "$x}{n}{$", "fallback", "B", "", "unbalanced_close_brace", 1),
    ("a\x01b $x\x02y^{n}$ c\x03", Q, "feedback", "a\x01b $x\x02y^{n}$ c\x03", "math", "G", "", "", 3),
    ("one {n}\\n2 two", Q, "feedback", "one {n}\\n2 two", "text", "L", "", "", 1),
)
COLUMNS = ("raw", "path", "family", "prepared", "outcome", "buckets", "repairs", "reasons", "segments")
CATEGORIES, TENANTS = 4, 12


def rows(spark: SparkSession, sf_dir: str, table: str = "documents", key: str = "doc_id") -> DataFrame:
    """dataset_row_id, row_no, tenant, category, ui_surface, field_path, raw_text and expected_outcome, expected_buckets, expected_repairs, expected_prepared for each row of a table."""
    n = F.expr(key).cast("long")
    which = F.pmod(n, F.lit(len(T))).cast("int") + 1
    pick = lambda k: F.element_at(F.array(*(F.lit(t[k]) for t in T)), which)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(
        F.concat(F.lit("latex-"), F.lpad(n.cast("string"), 7, "0")).alias("dataset_row_id"), n.alias("row_no"), F.concat(F.lit("tenant_"), F.lpad((n % TENANTS + 1).cast("string"), 3, "0")).alias("tenant"),
        F.concat(F.lit("category_"), (n % CATEGORIES).cast("string")).alias("category"), F.when(n % 3 == 0, "feedback").when(n % 3 == 1, "question_body").otherwise("student_answer").alias("ui_surface"),
        pick(1).alias("field_path"), F.replace(pick(0), F.lit("{n}"), n.cast("string")).alias("raw_text"),
        pick(4).alias("expected_outcome"), F.split(pick(5), "\\|").alias("expected_buckets"), F.filter(F.split(pick(6), "\\|"), lambda x: x != "").alias("expected_repairs"), F.replace(pick(3), F.lit("{n}"), n.cast("string")).alias("expected_prepared"),
    )


def _sql(value: str | int | None) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else " || ".join("'" + p.replace("'", "''") + "'" if p > "\x03" or not p else f"chr({ord(p)})" for p in re.split("([\x01-\x03])", value))


#: DuckDB: h has what is known of each row.
KNOWN = (
    "WITH t(k, " + ", ".join(COLUMNS) + ") AS (VALUES " + ", ".join("(" + ", ".join([str(k), *map(_sql, t)]) + ")" for k, t in enumerate(T)) + "),\n"
    "h AS (SELECT 'latex-' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS dataset_row_id, doc_id AS row_no, 'tenant_' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 3, '0') AS tenant, 'category_' || CAST(doc_id % 4 AS VARCHAR) AS category,\n"
    "  CASE doc_id % 3 WHEN 0 THEN 'feedback' WHEN 1 THEN 'question_body' ELSE 'student_answer' END AS ui_surface, path AS field_path, family, outcome, buckets, repairs, reasons, segments,\n"
    "  replace(raw, '{n}', CAST(doc_id AS VARCHAR)) AS raw_text, replace(prepared, '{n}', CAST(doc_id AS VARCHAR)) AS prepared_text FROM documents JOIN t ON doc_id % " + str(len(T)) + " = k)\n"
)
