"""The engine's queries over the template corpus and the driver's tables, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dialect as D
from ..functions.text import net_braces, shortened, unescaped_dollars
from ..operators import diagnose
from . import reports as R
from .corpus import KNOWN, rows
from .engine import Engine

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def healed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Engine().heal(rows(spark, sf_dir))


def _add(name: str, sql: str | None, make) -> None:
    QUERIES[name] = make
    if sql:
        ORACLE_SQL[name] = sql


def _on_healed(name: str, sql: str, make) -> None:
    _add(name, KNOWN + sql, lambda spark, d: make(healed(spark, d)))


def _on_rows(name: str, sql: str, make) -> None:
    _add(name, KNOWN + sql, lambda spark, d: make(rows(spark, d)))


def _on(name: str, table: str, sql: str, make) -> None:
    _add(name, sql, lambda spark, d: make(spark.read.parquet(f"{d}/{table}.parquet")))


join = lambda c: F.array_join(c, "|")
long = lambda c: c.cast("long")

# Healing, row by row
_on_healed("heal_prepared_text", "SELECT dataset_row_id, prepared_text FROM h", lambda h: h.select("dataset_row_id", "prepared_text"))
_on_healed("heal_outcome", "SELECT dataset_row_id, family, outcome, outcome = 'math' AS had_math, outcome = 'fallback' AS had_fallback FROM h", lambda h: h.select("dataset_row_id", "family", F.col("row_outcome").alias("outcome"), "had_math", "had_fallback"))
_on_healed("heal_buckets", "SELECT dataset_row_id, buckets FROM h", lambda h: h.select("dataset_row_id", join("buckets").alias("buckets")))
_on_healed("heal_repairs", "SELECT dataset_row_id, repairs FROM h", lambda h: h.select("dataset_row_id", join("repairs_applied").alias("repairs")))
_on_healed("heal_reasons", "SELECT dataset_row_id, reasons FROM h", lambda h: h.select("dataset_row_id", join("failure_reasons").alias("reasons")))
_on_healed("segment_count", "SELECT dataset_row_id, CAST(segments AS BIGINT) AS n FROM h", lambda h: h.select("dataset_row_id", long(F.size("segments")).alias("n")))
_add("heal_idempotence", KNOWN + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed FROM h", lambda spark, d: _twice(healed(spark, d)))
_add("heal_html", None, lambda spark, d: healed(spark, d).select("dataset_row_id", "html"))
_add("segments", None, lambda spark, d: healed(spark, d).select("dataset_row_id", F.posexplode("segments").alias("no", "s")).select("dataset_row_id", "no", "s.kind", "s.original", "s.start", "s.end", "s.repaired", "s.outcome", "s.score", join("s.repairs").alias("repairs"), join("s.reasons").alias("reasons")))
_add("signals", None, lambda spark, d: healed(spark, d).select("dataset_row_id", F.explode("segments").alias("s")).where("s.signals IS NOT NULL").select("dataset_row_id", "s.signals.known_commands", "s.signals.super", "s.signals.sub", "s.signals.operators", "s.signals.digits", join("s.signals.corruption").alias("corruption"), "s.score"))


def whole(spark: SparkSession, sf_dir: str, table: str, key: str, text: str) -> DataFrame:
    """The whole texts of a table, healed; no field path is known of them."""
    raw = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key, F.col(text).cast("string").alias("raw_text"), F.lit(None).cast("string").alias("field_path"))
    return Engine().heal(raw).select(key, "prepared_text", "row_outcome", join("buckets").alias("buckets"), join("repairs_applied").alias("repairs"), join("failure_reasons").alias("reasons"), long(F.size("segments")).alias("n_segments"), "html")


_add("heal_documents", None, lambda spark, d: whole(spark, d, "documents", "doc_id", "text"))
_add("heal_pages", None, lambda spark, d: whole(spark, d, "pages", "page_id", "html"))


def _twice(h: DataFrame) -> DataFrame:
    first = h.select(F.col("prepared_text").alias("raw_text"), "field_path")
    return Engine().heal(first).agg(F.count("*").alias("n"), F.count_if(~F.col("raw_text").eqNullSafe(F.col("prepared_text"))).alias("changed"))


# Reports
_on_healed("report_totals", "SELECT count(*) AS n_rows, count(*) FILTER (outcome = 'math') AS n_math, count(*) FILTER (outcome = 'fallback') AS n_fallback, count(*) FILTER (repairs <> '') AS n_repair, round(count(*) FILTER (outcome = 'fallback') / count(*), 4) AS fallback_rate, round(count(*) FILTER (repairs <> '') / count(*), 4) AS repair_rate, round(count(*) FILTER (outcome = 'fallback') / count(*), 4) < 0.05 AS gate_ok FROM h", R.totals)
for _name, _array, _known in (("repair", "repairs_applied", "repairs"), ("reason", "failure_reasons", "reasons"), ("bucket", "buckets", "buckets")):
    _on_healed(f"{_name}_counts", f"SELECT {_name}, count(*) AS n FROM (SELECT unnest(string_split({_known}, '|')) AS {_name} FROM h WHERE {_known} <> '') GROUP BY ALL", lambda h, a=_array, n=_name: R.exploded_counts(h, a, n))
for _by in ("category", "family"):
    _on_healed(f"{_by}_by_status", f"SELECT {_by}, CASE WHEN outcome = 'fallback' THEN 'fallback' ELSE 'ok' END AS value, count(*) AS n FROM h GROUP BY ALL", lambda h, b=_by: R.crosstab(h, b, R.status()))
_on_healed("category_by_outcome", "SELECT category, outcome AS value, count(*) AS n FROM h GROUP BY ALL", lambda h: R.crosstab(h, "category", F.col("row_outcome")))
_on_rows("category_surface_shares", "SELECT category, ui_surface, n, round(100 * n / sum(n) OVER (PARTITION BY category), 2) AS pct FROM (SELECT category, ui_surface, count(*) AS n FROM h GROUP BY ALL)", lambda r: R.shares(r, "category", "ui_surface"))
_on_healed("inspector_counts", " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM h GROUP BY ALL" for c in ("family", "category", "ui_surface", "tenant")), lambda h: R.breakdown(h, ["family", "category", "ui_surface", "tenant"]))
_on_healed("fallback_breakdown", " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM h WHERE outcome = 'fallback' GROUP BY ALL" for c in ("ui_surface", "field_path", "tenant")), lambda h: R.breakdown(h.where("had_fallback"), ["ui_surface", "field_path", "tenant"]))
_on_healed("fallback_primary_reason", "SELECT string_split(reasons, '|')[1] AS reason, count(*) AS n FROM h WHERE outcome = 'fallback' GROUP BY ALL", R.primary_reason)
_on_healed("first_last_per_reason", "SELECT reasons AS reason, row_no FROM h WHERE outcome = 'fallback' WINDOW w AS (PARTITION BY reasons) QUALIFY count(*) OVER w <= 10 OR row_number() OVER (PARTITION BY reasons ORDER BY row_no) <= 5 OR row_number() OVER (PARTITION BY reasons ORDER BY row_no) > count(*) OVER w - 5", lambda h: R.first_and_last(h.where("had_fallback").select("row_no", "failure_reasons"), F.get("failure_reasons", F.lit(0)), "row_no").select(F.col("group").alias("reason"), "row_no"))
_on_rows("stratified_sample", "SELECT dataset_row_id FROM (SELECT DISTINCT dataset_row_id, draw FROM (SELECT dataset_row_id, draw, row_number() OVER (PARTITION BY s ORDER BY draw, dataset_row_id) AS rn FROM (SELECT dataset_row_id, md5('7:' || dataset_row_id) AS draw, unnest(['tenant=' || tenant, 'category=' || category]) AS s FROM h)) WHERE rn <= 5) ORDER BY draw, dataset_row_id LIMIT 40", lambda r: R.stratified(r, "dataset_row_id", ["tenant", "category"], 5, 40))
_on_healed("facet_filter", "SELECT dataset_row_id FROM h WHERE tenant IN ('tenant_001', 'tenant_002', 'tenant_003') AND list_has_any(string_split(buckets, '|'), ['A', 'D', 'G'])", lambda h: R.facets(h, tenant=["tenant_001", "tenant_002", "tenant_003"], buckets=["A", "D", "G"]).select("dataset_row_id"))
_on_healed("text_search", "SELECT dataset_row_id FROM h WHERE contains(lower(concat_ws(' ', dataset_row_id, raw_text, replace(repairs, '|', ' '), family, ui_surface, category)), 'eta_to')", lambda h: R.facets(h, " ETA_to ").select("dataset_row_id"))
_on_healed("top_repairs", "SELECT repair, n, round(n / max(n) OVER (), 4) AS bar FROM (SELECT repair, count(*) AS n FROM (SELECT unnest(string_split(repairs, '|')) AS repair FROM h WHERE repairs <> '') GROUP BY ALL ORDER BY n DESC, repair LIMIT 8)", lambda h: R.top(R.exploded_counts(h, "repairs_applied", "repair"), "repair", 8))
_on_healed("longest_first", "SELECT dataset_row_id, CAST(length(raw_text) AS BIGINT) AS len FROM h WHERE raw_text IS NOT NULL ORDER BY len DESC, row_no LIMIT 200", lambda h: h.where("raw_text IS NOT NULL").select("dataset_row_id", "row_no", long(F.length("raw_text")).alias("len")).orderBy(F.desc("len"), "row_no").limit(200).drop("row_no"))
_on_healed("telemetry_counters", "SELECT family, outcome, repair, count(*) AS n FROM (SELECT family, outcome, unnest(string_split(repairs, '|')) AS repair FROM h WHERE repairs <> '') GROUP BY ALL", lambda h: h.select("family", F.col("row_outcome").alias("outcome"), F.explode("repairs_applied").alias("repair")).groupBy("family", "outcome", "repair").agg(F.count("*").alias("n")))
_on_healed("positional_join", "SELECT row_no, outcome, category FROM h", lambda h: R.paired(h.select("row_no", F.col("row_outcome").alias("outcome")), h.select("row_no", "category")))
_on_healed("predicted_errors", r"SELECT CASE WHEN reason LIKE 'forbidden_command:%' THEN 'Undefined control sequence: \' || split_part(reason, ':', 2) WHEN reason = 'subscript_run_too_long' THEN 'Expected group after ''_''' WHEN reason = 'brace_depth_exceeded' THEN '(too deeply nested — KaTeX maxExpand limit)' ELSE 'Expected ''}'' at end of input' END AS message, count(*) AS n FROM (SELECT unnest(string_split(reasons, '|')) AS reason FROM h WHERE reasons <> '') GROUP BY ALL", lambda h: R.exploded_counts(h.select(F.transform("failure_reasons", diagnose.predicted_error).alias("m")), "m", "message"))
_on_healed("bucket_recall", "SELECT label, count(*) AS n, 1.0::DOUBLE AS recall FROM (SELECT unnest(string_split(buckets, '|')) AS label FROM h) GROUP BY ALL", lambda h: R.recall(h, "expected_buckets", "buckets"))

_on_healed("repair_recall", "SELECT label, count(*) AS n, 1.0::DOUBLE AS recall FROM (SELECT unnest(string_split(repairs, '|')) AS label FROM h WHERE repairs <> '') GROUP BY ALL", lambda h: R.recall(h, "expected_repairs", "repairs_applied"))
_on_healed("outcome_confusion", "SELECT outcome AS expected, count(*) FILTER (outcome = 'math') AS math, count(*) FILTER (outcome = 'fallback') AS fallback, count(*) FILTER (outcome = 'text') AS text FROM h GROUP BY ALL", lambda h: R.confusion(h, "expected_outcome", "row_outcome", ["math", "fallback", "text"]))
_on_healed("full_match", "SELECT category, count(*) AS n, count(*) AS matched FROM h GROUP BY ALL", lambda h: R.full_match(h.withColumn("expected_no_repairs", F.array().cast("array<string>"))).groupBy("category").agg(F.count("*").alias("n"), F.count_if("full_ok").alias("matched")))
_on_healed("fallbacks_by_reason", "SELECT reason, n, keys FROM (SELECT reasons AS reason, count(*) AS n, array_to_string(list_slice(list(row_no ORDER BY row_no), 1, 10), '|') AS keys FROM h WHERE reasons <> '' GROUP BY ALL)", R.by_reason)
_on_healed("recovery_by_surface", "SELECT ui_surface, n, repaired, recovered, fallbacks, round(100 * repaired / n, 2) AS repaired_pct, round(100 * recovered / n, 2) AS recovered_pct, round(100 * fallbacks / n, 2) AS fallbacks_pct FROM (SELECT ui_surface, count(*) AS n, count(*) FILTER (repairs <> '') AS repaired, count(*) FILTER (repairs <> '' AND outcome <> 'fallback') AS recovered, count(*) FILTER (outcome = 'fallback') AS fallbacks FROM h GROUP BY ALL)", lambda h: R.recovery(h, "ui_surface"))
_on_rows("text_lengths", "SELECT category, count(*) AS n, CAST(sum(l) AS BIGINT) AS total, min(l) AS least, max(l) AS most, round(avg(l), 4) AS mean FROM (SELECT category, CAST(length(coalesce(raw_text, '')) AS BIGINT) AS l FROM h) GROUP BY ALL", lambda r: R.lengths(r, "category"))
_on_rows("first_rows", "SELECT dataset_row_id, row_no FROM h ORDER BY row_no LIMIT 25", lambda r: R.limited(r, "row_no", 25).select("dataset_row_id", "row_no"))
_on_rows("category_filter", "SELECT dataset_row_id FROM h WHERE category IN ('category_1', 'category_3')", lambda r: R.of_categories(r, ("category_1", "category_3")).select("dataset_row_id"))
_add("segment_kinds", None, lambda spark, d: R.segment_counts(healed(spark, d)))

# Rows of the corpus and the driver's tables
_on_rows("family_of", "SELECT dataset_row_id, family FROM h", lambda r: Engine().heal(r).select("dataset_row_id", "family"))
_on_rows("prior_join", "SELECT dataset_row_id, CASE family " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in D.PRIORS.items()) + " END::DOUBLE AS prior FROM h", lambda r: Engine().heal(r).select("dataset_row_id", "prior"))
_on_rows("unescaped_dollars", r"SELECT dataset_row_id, CAST(length(regexp_replace(coalesce(raw_text, ''), '(?s)\\.|[^$]', '', 'g')) AS INT) AS n FROM h", lambda r: r.select("dataset_row_id", unescaped_dollars(F.coalesce("raw_text", F.lit(""))).alias("n")))
_on_rows("net_braces", r"SELECT dataset_row_id, CAST(length(regexp_replace(b, '[^{]', '', 'g')) - length(regexp_replace(b, '[^}]', '', 'g')) AS INT) AS n FROM (SELECT dataset_row_id, regexp_replace(coalesce(raw_text, ''), '(?s)\\.', '', 'g') AS b FROM h)", lambda r: r.select("dataset_row_id", net_braces(F.coalesce("raw_text", F.lit(""))).alias("n")))
_on("html_route", "pages", r"SELECT page_id, regexp_matches(html, '(?i)<(table|tr|td|th|p|strong|br|thead|tbody|div|span)\b') AS is_html FROM pages", lambda t: t.select("page_id", F.col("html").rlike(D.HTML_ROUTE).alias("is_html")))
_on("shortened", "documents", "SELECT doc_id, CASE WHEN length(text) <= 60 THEN text ELSE substr(text, 1, 57) || '...' END AS short FROM documents", lambda t: t.select("doc_id", shortened(F.col("text"), 60, 57).alias("short")))
_on_rows("issue_counts", r"SELECT count(*) FILTER (length(regexp_replace(coalesce(raw_text, ''), '(?s)\\.|[^$]', '', 'g')) % 2 = 1) AS dollars, CAST(sum(len(regexp_extract_all(coalesce(raw_text, ''), '_{3,}'))) AS BIGINT) AS blanks FROM h", lambda r: r.select(diagnose.issues(F.col("raw_text")).alias("i")).agg(F.sum(F.size(F.filter("i", lambda x: x["kind"] == "unbalanced_dollar"))).alias("dollars"), F.sum(F.size(F.filter("i", lambda x: x["kind"] == "fill_blank_subscript_run"))).alias("blanks")))
_add("issues", None, lambda spark, d: rows(spark, d).select("dataset_row_id", "raw_text", F.explode(diagnose.issues(F.col("raw_text"))).alias("i")).select("dataset_row_id", "i.*", diagnose.context(F.col("raw_text"), F.col("i.position")).alias("context")))
_plain = {k: p for k, p in D.PROFILE.items() if "(?<!" not in p and "(?!" not in p}
_on("pattern_profile", "pages", " UNION ALL ".join(f"SELECT '{k}' AS feature, count(*) FILTER (regexp_matches(html, '{p}')) AS n, round(100 * count(*) FILTER (regexp_matches(html, '{p}')) / count(*), 2) AS pct FROM pages" for k, p in _plain.items()), lambda t: R.profile(t, "html", _plain))
_on("pattern_profile_documents", "documents", " UNION ALL ".join(f"SELECT '{k}' AS feature, count(*) FILTER (regexp_matches(text, '{p}')) AS n, round(100 * count(*) FILTER (regexp_matches(text, '{p}')) / count(*), 2) AS pct FROM documents" for k, p in _plain.items()), lambda t: R.profile(t, "text", _plain))
_add("pattern_profile_whole", None, lambda spark, d: R.profile(spark.read.parquet(f"{d}/pages.parquet"), "html"))
_add("pattern_profile_by_lang", None, lambda spark, d: R.profile(spark.read.parquet(f"{d}/documents.parquet"), "text", by="lang"))
_on_healed("outcome_counts", "SELECT outcome, count(*) AS n FROM h GROUP BY ALL", lambda h: h.groupBy(F.col("row_outcome").alias("outcome")).agg(F.count("*").alias("n")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Healed rows by family and outcome."""
    return healed(spark, sf_dir).groupBy("family", "row_outcome").agg(F.count("*").alias("n"))


_add("family_by_outcome", KNOWN + "SELECT family, outcome AS row_outcome, count(*) AS n FROM h GROUP BY ALL", flagship)
