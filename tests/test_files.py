from __future__ import annotations

import json

import pytest

from texmend.plans import reports
from texmend.plans.engine import Engine
from texmend.sources.files import file_stats, one_text, read_rows, write_report, write_telemetry
from texmend.streaming.heal import counters, heal_stream


def test_jsonl_and_csv(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"dataset_row_id": "1", "raw_text": "$x$", "extra": 1}\n\n{bad\n{"dataset_row_id": "2"}\n')
    got = read_rows(spark, str(tmp_path / "a.jsonl")).collect()
    assert [(r.dataset_row_id, r.raw_text) for r in got if r.dataset_row_id] == [("1", "$x$"), ("2", None)]
    (tmp_path / "b.csv").write_text('dataset_row_id,raw_text\n1,"two\nlines ""q"""\n2,\n')
    assert [tuple(r) for r in read_rows(spark, str(tmp_path / "b.csv")).collect()] == [("1", 'two\nlines "q"'), ("2", "")]
    with pytest.raises(ValueError):
        read_rows(spark, "x.parquet")
    assert file_stats(spark, str(tmp_path / "a.jsonl")).first().rows == 3


def test_telemetry(spark, tmp_path):
    df = one_text(spark, "so $x_1$").selectExpr("'id' AS dataset_row_id", "'c' AS category", "'u' AS ui_surface", "'p' AS field_path", "raw_text")
    write_telemetry(Engine().heal(df), str(tmp_path / "out"))
    line = json.loads("".join(f.read_text() for f in (tmp_path / "out").glob("*.json")))
    assert line["pipeline_error"] is None and [s["outcome"] for s in line["segments"]] == ["text", "math"]
    totals = reports.totals(Engine().heal(df)).first()
    assert (totals.n_rows, totals.n_math, totals.fallback_rate, totals.gate_ok) == (1, 1, 0.0, True)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("$\\frac{1}{2} rac{1}{2}$\n\nwords\n")
    healed = heal_stream(spark.readStream.text(str(tmp_path / "in")))
    query = counters(healed).writeStream.outputMode("complete").format("memory").queryName("counters").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    query.awaitTermination()
    got = {(r.family, r.row_outcome, r["repair"]): r["count"] for r in spark.table("counters").collect()}
    assert got == {("unknown", "math", "repair_orphan_rac"): 1, ("unknown", "text", None): 1}


def test_report(spark, tmp_path):
    counts = spark.createDataFrame([("a", 2), ("b", 3), ("c", 2)], "repair string, n long")
    write_report(spark.sql("SELECT 7 AS n_rows"), {"Repairs": counts}, str(tmp_path / "md"), 2)
    text = "".join(f.read_text() for f in (tmp_path / "md").glob("part-*"))
    assert text.split("\n")[:7] == ["# Report", "", "- n_rows: 7", "", "## Repairs", "", "- b: 3"] and "- a: 2" in text and "- c" not in text


def test_full_match(spark):
    row = "SELECT 'math' AS row_outcome, 'math' AS expected_outcome, array('A', 'D') AS buckets, array('D') AS expected_buckets, array('x') AS repairs_applied, "
    sql = " UNION ALL ".join(row + f"{wanted} AS expected_repairs, {banned} AS expected_no_repairs, 't' AS prepared_text, {text} AS expected_prepared, {k} AS k" for k, (wanted, banned, text) in enumerate([("array('x')", "array('y')", "'t'"), ("array('y')", "NULL", "NULL"), ("NULL", "array('x')", "NULL"), ("NULL", "NULL", "'u'"), ("NULL", "NULL", "NULL")]))
    assert [r.full_ok for r in reports.full_match(spark.sql(sql)).orderBy("k").collect()] == [True, False, False, False, True]
