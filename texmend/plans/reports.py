"""Reports over healed rows: counts, crosstabs, shares, samples, facets, evaluation. Only these shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dialect as D
from ..functions.text import net_braces, unescaped_dollars


def status(error: Column | None = None) -> Column:
    out = F.when(F.col("had_fallback"), "fallback").otherwise("ok")
    return out if error is None else F.when(error.isNotNull(), "pipeline_error").otherwise(out)


def limited(df: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first n rows by order, or all."""
    return df if n is None else df.orderBy(order).limit(n)


def of_categories(df: DataFrame, categories: tuple[str, ...] = D.BROKEN_CATEGORIES) -> DataFrame:
    return df.where(F.col("category").isin(*categories))


def lengths(df: DataFrame, by: str, text: str = "raw_text") -> DataFrame:
    """n, total, least, most and mean length of texts by a column; null texts count 0."""
    n = F.length(F.coalesce(text, F.lit(""))).cast("long")
    return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(n).alias("total"), F.min(n).alias("least"), F.max(n).alias("most"), F.round(F.avg(n), 4).alias("mean"))


def segment_counts(df: DataFrame) -> DataFrame:
    """Segments by kind and outcome."""
    return df.select(F.explode("segments").alias("s")).groupBy(F.col("s.kind").alias("kind"), F.col("s.outcome").alias("outcome")).agg(F.count("*").alias("n"))


def by_reason(df: DataFrame, key: str = "row_no", most: int = 10) -> DataFrame:
    """For each failure reason its rows and the `most` smallest keys."""
    rows = df.select(key, F.explode(F.array_distinct("failure_reasons")).alias("reason"))
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("reason").orderBy(key))).where(F.col("rn") <= most)
    keys = ranked.groupBy("reason").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")), "|").alias("keys"))
    return rows.groupBy("reason").agg(F.count("*").alias("n")).join(keys, "reason")


def recovery(df: DataFrame, by: str) -> DataFrame:
    """By a column: rows, rows repaired, rows repaired that render, and fallbacks, with their percentages of the rows."""
    fixed = F.size("repairs_applied") > 0
    out = df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(fixed).alias("repaired"), F.count_if(fixed & ~F.col("had_fallback")).alias("recovered"), F.count_if(F.col("had_fallback")).alias("fallbacks"))
    return out.select("*", *(F.round(100 * F.col(c) / F.col("n"), 2).alias(f"{c}_pct") for c in ("repaired", "recovered", "fallbacks")))


def totals(df: DataFrame) -> DataFrame:
    """n_rows, n_math, n_fallback, n_repair and the rates, 0 for no rows; the quality gate is fallback_rate < 0.05."""
    n = F.count("*")
    some = lambda c: F.count_if(c).alias
    out = df.agg(n.alias("n_rows"), some(F.col("had_math"))("n_math"), some(F.col("had_fallback"))("n_fallback"), some(F.size("repairs_applied") > 0)("n_repair"))
    rate = lambda c: F.when(F.col("n_rows") > 0, F.round(F.col(c) / F.col("n_rows"), 4)).otherwise(F.lit(0.0))
    return out.withColumn("fallback_rate", rate("n_fallback")).withColumn("repair_rate", rate("n_repair")).withColumn("gate_ok", F.col("fallback_rate") < 0.05)


def exploded_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Occurrences of the elements of an array column."""
    return df.select(F.explode(column).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, by: str, value: Column) -> DataFrame:
    return df.groupBy(by, value.alias("value")).agg(F.count("*").alias("n"))


def shares(df: DataFrame, group: str, within: str) -> DataFrame:
    """Rows by group and value, and each value's percentage of its group."""
    out = df.groupBy(group, within).agg(F.count("*").alias("n"))
    return out.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(group)), 2))


def breakdown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of each column's values, all columns in one pass: (facet, value, n)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("facet"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n")).select("facet", "value", "n")


def primary_reason(df: DataFrame) -> DataFrame:
    return df.where("had_fallback").groupBy(F.coalesce(F.get("failure_reasons", F.lit(0)), F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


def first_and_last(df: DataFrame, group: Column, order: str, most: int = 10, ends: int = 5) -> DataFrame:
    """All rows of groups of at most `most`, else the first and last `ends` of them."""
    own = df.withColumn("group", group)
    #: Ranks up to `most` only, from either side, so that Spark cuts each group before its shuffle.
    ranked = lambda o, n: own.withColumn("rn", F.row_number().over(Window.partitionBy("group").orderBy(o))).where(F.col("rn") <= n).drop("rn")
    small = own.groupBy("group").agg(F.count("*").alias("size")).where(F.col("size") <= most).select("group")
    few = ranked(order, most).join(small, "group", "left_semi")
    large = ranked(order, ends).unionByName(ranked(F.desc(order), ends)).join(small, "group", "left_anti")
    return few.unionByName(large)


def stratified(df: DataFrame, key: str, strata: list[str], each: int, most: int, seed: str = "7") -> DataFrame:
    """Up to `each` rows of every value of every stratum column, united, at most `most` rows; order by seeded hash, so reruns agree."""
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary"))
    pairs = F.explode(F.array(*(F.concat_ws("=", F.lit(c), F.coalesce(c, F.lit(""))) for c in strata)))
    ranked = df.select(key, drawn.alias("draw"), pairs.alias("stratum")).withColumn("rn", F.row_number().over(Window.partitionBy("stratum").orderBy("draw", key)))
    return ranked.where(F.col("rn") <= each).select(key, "draw").distinct().orderBy("draw", key).limit(most).select(key)


def facets(df: DataFrame, search: str = "", **chosen: list[str]) -> DataFrame:
    """Rows that match all facets (any value within one; arrays overlap) and hold the search text, whatever its case."""
    kinds = dict(df.dtypes)
    for column, values in chosen.items():
        if values:
            df = df.where(F.arrays_overlap(column, F.array(*map(F.lit, values))) if kinds[column].startswith("array") else F.col(column).isin(*values))
    if search.strip():
        hay = F.concat_ws(" ", "dataset_row_id", "raw_text", F.array_join("repairs_applied", " "), "family", "ui_surface", "category")
        df = df.where(F.lower(hay).contains(search.strip().lower()))
    return df


def top(df: DataFrame, name: str, n: int) -> DataFrame:
    """The n largest counts with their share of the largest, ties by name."""
    cut = df.orderBy(F.desc("n"), name).limit(n)
    return cut.withColumn("bar", F.round(F.col("n") / F.max("n").over(Window.partitionBy()), 4))


def features(text: Column, patterns: dict[str, str] | None = None) -> dict[str, Column]:
    """Whether each pattern matches, and, of the whole profile, whether dollars and braces don't balance. Of a null text none holds."""
    own = {k: F.coalesce(text.rlike(p), F.lit(False)) for k, p in (patterns or D.PROFILE).items()}
    if patterns is None:
        own["unbalanced_dollar"] = F.coalesce(text.contains("$") & (unescaped_dollars(text) % 2 == 1), F.lit(False))
        own["unbalanced_braces"] = F.coalesce(text.rlike("[{}]") & (net_braces(text) != 0), F.lit(False))
    return own


def profile(df: DataFrame, text: str, patterns: dict[str, str] | None = None, by: str | None = None) -> DataFrame:
    """Rows with each feature, and their percentage, in one pass; by: of each value of that column."""
    own = features(F.col(text), patterns)
    keys = [by] if by else []
    out = df.groupBy(*keys).agg(F.count("*").alias("rows"), *(F.count_if(c).alias(k) for k, c in own.items()))
    return out.unpivot(["rows", *keys], list(own), "feature", "n").select(*keys, "feature", "n", F.when(F.col("rows") > 0, F.round(100 * F.col("n") / F.col("rows"), 2)).otherwise(0.0).alias("pct"))


def recall(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """Of each expected element, the share of rows that have it."""
    return df.select(F.explode(expected).alias("label"), actual).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(F.array_contains(F.col(actual), F.col("label")).cast("double")), 4).alias("recall"))


def confusion(df: DataFrame, expected: str, actual: str, values: list[str]) -> DataFrame:
    return df.groupBy(F.col(expected).alias("expected")).pivot(actual, values).count().na.fill(0)


def full_match(df: DataFrame) -> DataFrame:
    """df with full_ok: outcome as expected, a bucket shared, all expected repairs made, none of the forbidden, and the exact text where one is expected."""
    none = F.array().cast("array<string>")
    wanted, banned, buckets = (F.coalesce(c, none) for c in ("expected_repairs", "expected_no_repairs", "expected_buckets"))
    made = F.coalesce("repairs_applied", none)
    ok = F.col("row_outcome").eqNullSafe(F.col("expected_outcome")) & ((F.size(buckets) == 0) | F.arrays_overlap(buckets, "buckets"))
    ok &= (F.size(F.array_except(wanted, made)) == 0) & (F.size(F.array_intersect(banned, made)) == 0)
    return df.withColumn("full_ok", ok & (F.col("expected_prepared").isNull() | F.col("prepared_text").eqNullSafe(F.col("expected_prepared"))))


def paired(a: DataFrame, b: DataFrame, key: str = "row_no") -> DataFrame:
    """Rows of two tables that carry a row number each. No reader attaches one yet."""
    return a.join(b, key)
