"""Readers and writers of row files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "dataset_row_id string, raw_text string, field_path string, category string, ui_surface string, tenant string, source_table string, subject_name string, grade_name string"


def read_rows(spark: SparkSession, path: str, schema: str = ROW) -> DataFrame:
    """Rows of a .jsonl or .csv path: malformed and blank lines are left out, empty CSV cells are empty texts."""
    if path.endswith(".jsonl"):
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).na.fill("")
    raise ValueError(f"unsupported format: {path}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row a file, column raw_text."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw_text")


def one_text(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(text,)], "raw_text string")


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """file, non-blank lines of line files."""
    return spark.read.text(path).where(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def write_telemetry(df: DataFrame, path: str) -> None:
    """One JSON object for each healed row, nulls kept."""
    part = F.transform("segments", lambda s: F.struct(s["kind"].alias("kind"), s["outcome"].alias("outcome"), F.round(s["score"], 3).alias("score"), s["repairs"].alias("repairs"), s["reasons"].alias("validation_reasons")))
    df.select("dataset_row_id", "category", "family", "ui_surface", "buckets", "had_math", "had_fallback", F.lit(None).cast("string").alias("pipeline_error"), part.alias("segments"), "prepared_text").write.option("ignoreNullFields", False).json(path)


def write_report(totals: DataFrame, counts: dict[str, DataFrame], path: str, most: int = 20) -> None:
    """A Markdown report of one row of totals and of counts (name, n), the `most` largest of each, as text under path."""
    spark = totals.sparkSession
    lines = ["# Report", "", *(f"- {k}: {v}" for k, v in totals.first().asDict().items())]
    for title, df in counts.items():
        name = next(c for c in df.columns if c != "n")
        found = df.orderBy(F.desc("n"), name).limit(most).collect()
        lines += ["", f"## {title}", "", *(f"- {r[name]}: {r['n']}" for r in found)]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
