from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from texmend.functions import dialect as D
from texmend.functions.text import positions
from texmend.operators import diagnose
from texmend.operators import stages as S
from texmend.plans import reports as R
from texmend.plans.corpus import P, Q, T
from texmend.plans.engine import Engine, arrow
from texmend.plans.queries import QUERIES


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(k, t[0] and t[0].replace("{n}", "7"), t[1]) for k, t in enumerate(T)]
    return {r.k: r for r in Engine().heal(spark.createDataFrame(rows, "k int, raw_text string, field_path string")).collect()}


@pytest.mark.parametrize("k", range(len(T)))
def test_templates(golden, k):
    r, t = golden[k], T[k]
    got = (r.family, r.prepared_text, r.row_outcome, "|".join(r.buckets), "|".join(r.repairs_applied), "|".join(r.failure_reasons), len(r.segments))
    assert got == (t[2], t[3].replace("{n}", "7"), *t[4:])


def test_more_cases(spark):
    cases = [
        ("$x̑ = 2$", Q, "$x = 2$", "math", ["strip_combining_diacritics"]), ("$̑$", Q, "$̑$", "text", ["strip_combining_diacritics"]), ("$$$$", Q, "$$$$", "text", []), ("é", Q, "é", "text", ["nfc_normalize"]),
        ("<foo>$a$</foo> <b>\\n</b>", Q, "<foo>$a$</foo> <b>\\n</b>", "math", []), ("$a}$", Q, "$a}$", "fallback", []), ("\\( unclosed", P, "\\( unclosed", "text", []), ("  x^2 ", P, "  $x^2$ ", "math", ["wrap_math_only"]),
    ]
    rows = Engine().heal(spark.createDataFrame([(k, *c[:2]) for k, c in enumerate(cases)], "k int, raw_text string, field_path string")).orderBy("k").collect()
    for r, (_, _, prepared, outcome, repairs) in zip(rows, cases, strict=True):
        assert (r.prepared_text, r.row_outcome) == (prepared, outcome)
        assert [x for x in r.repairs_applied if x != "literal_escape_to_whitespace"] == repairs
    assert 'class="latex-fallback-soft" data-render-reason="math_emptied_by_repair"' in rows[1].html
    assert rows[5].html == '<span class="latex-fallback" data-render-reason="unbalanced_close_brace">$a}$</span>'


def test_vocabulary():
    assert len(D.VOCABULARY) == 359


def test_issues(spark):
    df = spark.createDataFrame([("a } b { eta $",), ("\\input x ____",), (None,)], "t string")
    got = [[(i.kind, i.position) for i in r.i] for r in df.select(diagnose.issues(F.col("t")).alias("i")).collect()]
    assert got[0] == [("extra_closing_brace", 2), ("missing_closing_brace", 6), ("unbalanced_dollar", 12), ("orphan_eta", 8)]
    assert got[1] == [("fill_blank_subscript_run", 9), ("forbidden_command", 0)]
    assert got[2] == []
    assert df.select(positions(F.col("t"), "b|x")).first()[0] == [4]


def test_plug_ins(spark):
    df = spark.createDataFrame([("$\\alpha_1 + foo$", Q)], "raw_text string, field_path string")
    native = Engine().adding("foo_to_bar", lambda c: F.replace(c, F.lit("foo"), F.lit("bar")))
    row = native.heal(df).first()
    assert row.prepared_text == "$\\alpha_1 + bar$" and row.repairs_applied == ["foo_to_bar"]
    assert Engine(longest=3).heal(df).first().failure_reasons == ["exceeds_max_length"]
    assert df.select(arrow(str.upper)("raw_text")).first()[0] == "$\\ALPHA_1 + FOO$"


def test_outside_signals(spark):
    df = spark.createDataFrame([("12 apples",), ("____",), ("word",)], "t string")
    s = [r.s for r in df.select(S.signals(F.col("t"), False).alias("s")).collect()]
    assert [x.currency for x in s] == [True, False, False]
    assert [x.fill_blank for x in s] == [False, True, False]
    assert [x.pure_alpha_token for x in s] == [False, False, True]


def test_whole_documents_and_pages(spark, tmp_path):
    words = "plain words " * 400
    texts = [words, words + "$\\frac{1}{7} \\times rac{2}{5}$", "First line\\nSecond line", None, "long " * 4000]
    want = [words, words + "$\\frac{1}{7} \\times \\frac{2}{5}$", "First line\nSecond line", "", "long " * 4000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    page = "<p>Solve $x_{7}$ now</p>" + "<div>more words</div>" * 200
    spark.createDataFrame([(1, page)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["heal_documents"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.prepared_text for r in got] == want
    assert got[1].repairs == "repair_orphan_rac" and got[1].row_outcome == "math" and got[2].repairs == "literal_escape_to_whitespace"
    out = QUERIES["heal_pages"](spark, str(tmp_path)).first()
    assert out.prepared_text == page and "F" in out.buckets.split("|") and out.row_outcome == "math"


def test_long_and_marked_texts_survive(spark):
    rows = [
        ("a", "$\\alpha" + "{a}" * 20000 + "}{b}$", "assignment_question.body.rubric_steps[0].criterion"), ("b", "$1" + ",11" * 40000 + "...", "feedback"), ("c", "$\\text{" + "a" * 30000 + "____}$", "feedback"), ("d", "1" + ",11" * 30000, "feedback"),
        ("e", "a\x01b $x\x02y$ c\x03", "feedback"), ("f", "<p>a\x01b</p>\x03a", "feedback"),
    ]
    df = spark.createDataFrame(rows, "dataset_row_id string, raw_text string, field_path string")
    got = {r.dataset_row_id: r.prepared_text for r in Engine().heal(df).collect()}
    assert got["e"] == rows[4][1] and got["f"] == rows[5][1] and got["b"] == rows[1][1]
    assert {r.feature: r.n for r in R.profile(df, "raw_text").collect()}["has_currency_amount"] >= 1


def test_combining_mark_is_named(spark):
    from texmend.operators import diagnose

    got = spark.createDataFrame([("x̃",)], "t string").select(diagnose.issues(F.col("t")).alias("i")).first().i
    assert [(x.kind, x.position, x.found) for x in got] == [("combining_diacritic", 1, "U+0303")]


def test_whole_profile_by_brute_force(spark):
    import re

    from texmend.functions import dialect as D

    texts = ["eta rac{1} \\n2 ext{a}", "$x", "{{}", "alphaeta \\alpha^2", None, "", "\\n a", "beta"]
    df = spark.createDataFrame([(t, "u" if k % 2 else "v") for k, t in enumerate(texts)], "t string, g string")
    got = {(r.g, r.feature): r.n for r in R.profile(df, "t", by="g").collect()}
    for g in ("u", "v"):
        own = [t for k, t in enumerate(texts) if (k % 2 == 1) == (g == "u") and t is not None]
        for name, p in D.PROFILE.items():
            assert got[g, name] == sum(bool(re.search(p, t)) for t in own), name
    assert got["u", "unbalanced_dollar"] == 1 and got["v", "unbalanced_braces"] == 1
