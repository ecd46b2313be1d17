"""heal(): the whole row pipeline as one narrow plan, for batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dialect as D
from ..functions.text import escape_html, family, nfc, prior, remarked, strip, unescaped_dollars, unmarked
from ..operators import stages as S

Repair = tuple[str, Callable[[Column], Column]]


@dataclass(frozen=True)
class Engine:
    """Settings and plug-ins. A plug-in repair is (name, Column to Column); `str -> str` functions go through arrow()."""

    repair_threshold: float = 0.7
    inside_boost: float = 0.6
    family_weight: float = 0.15
    wrap_threshold: float = 0.5
    longest: int = 8000
    deepest: int = 32
    forbidden: tuple[str, ...] = D.FORBIDDEN
    css_class: str = "latex-fallback"
    priors: dict[str, float] = field(default_factory=dict)
    repair_buckets: dict[str, str] = field(default_factory=dict)
    prose_repairs: tuple[Repair, ...] = (("literal_escape_to_whitespace", S.literal_escapes),)
    math_repairs: tuple[Repair, ...] = S.MATH_REPAIRS

    def having(self, **settings) -> Engine:
        return replace(self, **settings)

    def adding(self, name: str, repair: Callable[[Column], Column]) -> Engine:
        return replace(self, math_repairs=(*self.math_repairs, (name, repair)))

    # Segments

    def _chunks(self, text: Column, is_html: Column) -> Column:
        cut = F.transform(F.filter(F.split(F.regexp_replace(unmarked(text), D.HTML_TAG, "\u0001$0\u0001"), "\u0001", -1), lambda x: x != ""), remarked)
        return F.when(is_html, cut).otherwise(F.array(text))

    def _global(self, chunk: Column, p: Column, is_html: Column) -> Column:
        tag = is_html & chunk.rlike("^" + D.HTML_TAG + "$") & F.lower(F.regexp_extract(chunk, D.HTML_TAG, 1)).isin(*D.HTML_TAGS)
        return F.struct(tag.alias("tag"), chunk.alias("raw"), F.when(tag, chunk).otherwise(nfc(chunk)).alias("nfc"), p.alias("prior"))

    def _wrapped(self, x: Column) -> Column:
        w = S.wrap(x["nfc"], x["prior"], self.wrap_threshold)
        return F.struct(x["tag"].alias("tag"), F.when(x["tag"], x["raw"]).otherwise(w["text"]).alias("text"), F.array_compact(F.array(F.when(~x["tag"] & ~x["raw"].eqNullSafe(x["nfc"]), F.lit("nfc_normalize")), F.when(~x["tag"], w["name"]))).alias("repairs"))

    def _first(self, s: Column, p: Column) -> Column:
        math = s["kind"].startswith("math_")
        sig = S.signals(s["content"], True)
        return F.struct(s["kind"].alias("kind"), s["content"].alias("c0"), s["start"].alias("start"), s["end"].alias("end"), math.alias("math"), F.when(math, sig).alias("sig"), F.when(math, S.diacritics(s["content"])).otherwise(s["content"]).alias("c1"), p.alias("prior"))

    def _second(self, s: Column) -> Column:
        emptied = s["math"] & (strip(s["c1"]) == "")
        score = S.score(s["sig"], s["prior"], True, self.inside_boost, self.family_weight)
        gate = s["math"] & ~emptied & ((F.size(s["sig"]["corruption"]) > 0) | (score >= self.repair_threshold))
        return F.struct(*(s[c].alias(c) for c in ("kind", "c0", "start", "end", "math", "c1", "prior")), s["sig"].alias("sig"), F.round(score, 9).alias("score"), emptied.alias("emptied"), gate.alias("gate"), s["c1"].alias("c"), F.when(s["math"] & (s["c0"] != s["c1"]), F.array(F.lit("strip_combining_diacritics"))).otherwise(F.array().cast("array<string>")).alias("repairs"))

    def _repaired(self, s: Column, name: str, repair: Callable[[Column], Column], when: Column) -> Column:
        new = F.when(when, repair(s["c"])).otherwise(s["c"])
        keep = [s[c].alias(c) for c in ("kind", "c0", "start", "end", "math", "c1", "prior", "sig", "score", "emptied", "gate")]
        return F.struct(*keep, new.alias("c"), F.when(new != s["c"], F.array_append(s["repairs"], F.lit(name))).otherwise(s["repairs"]).alias("repairs"))

    def _step(self, name: str, repair: Callable[[Column], Column], when: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda s: self._repaired(s, name, repair, when(s))

    def _judged(self, s: Column) -> Column:
        checked = s["math"] & ~s["emptied"]
        sig2 = F.when(checked, S.signals(s["c"], True)).otherwise(s["sig"])
        why = F.when(checked, S.reasons(s["c"], self.longest, self.deepest, self.forbidden)).otherwise(F.array().cast("array<string>"))
        return F.struct(*(s[c].alias(c) for c in ("kind", "c0", "start", "end", "math", "prior", "score", "emptied", "c", "repairs")), sig2.alias("sig"), why.alias("reasons"))

    def _rendered(self, s: Column) -> Column:
        outcome = F.when(~s["math"] | s["emptied"], "text").when(F.size(s["reasons"]) > 0, "fallback").otherwise("math")
        prepared = F.when(~s["math"], s["c"]).when(s["emptied"], S.delimited(s["kind"], s["c0"])).otherwise(S.delimited(s["kind"], s["c"]))
        return F.struct(
            F.when(s["emptied"], "text").otherwise(s["kind"]).alias("kind"), s["c0"].alias("original"), s["start"].alias("start"), s["end"].alias("end"), s["c"].alias("repaired"), outcome.alias("outcome"), s["repairs"].alias("repairs"), s["reasons"].alias("reasons"),
            F.when(~s["math"], 0.0).when(s["emptied"], s["score"]).otherwise(F.round(S.score(s["sig"], s["prior"], True, self.inside_boost, self.family_weight), 9)).alias("score"),
            s["sig"].alias("signals"), prepared.alias("prepared"),
        )

    def _html(self, s: Column) -> Column:
        span = lambda css, reason, body: F.concat(F.lit(f'<span class="{css}" data-render-reason="'), escape_html(reason), F.lit('">'), escape_html(body), F.lit("</span>"))
        mode = F.when(s["kind"].isin("math_display", "math_bracket"), "display").otherwise("inline")
        soft = (s["outcome"] == "text") & (s["prepared"] != s["repaired"])
        return (
            F.when(s["outcome"] == "math", F.concat(F.lit('<span class="latex-math" data-math="'), mode, F.lit('">'), escape_html(s["prepared"]), F.lit("</span>"))).when(s["outcome"] == "fallback", span(self.css_class, F.array_join(s["reasons"], ";"), s["prepared"]))
            .when(soft, F.replace(span(self.css_class, F.lit("math_emptied_by_repair"), s["prepared"]), F.lit('class="latex-fallback"'), F.lit('class="latex-fallback-soft"'))).otherwise(F.replace(escape_html(s["prepared"]), F.lit("\n"), F.lit("<br>")))
        )

    def _segments(self, chunk: Column, p: Column) -> Column:
        out = F.transform(S.tokenize(chunk["text"]), lambda s: self._first(s, p))
        out = F.transform(out, self._second)
        for name, repair in self.prose_repairs:
            out = F.transform(out, self._step(name, repair, lambda s: ~s["math"]))
        for name, repair in self.math_repairs:
            out = F.transform(out, self._step(name, repair, lambda s: s["gate"]))
        out = F.transform(F.transform(out, self._judged), self._rendered)
        tag = F.array(F.struct(F.lit("html").alias("kind"), chunk["text"].alias("original"), F.lit(0).alias("start"), F.length(chunk["text"]).alias("end"), chunk["text"].alias("repaired"), F.lit("html").alias("outcome"), F.array().cast("array<string>").alias("repairs"), F.array().cast("array<string>").alias("reasons"), F.lit(0.0).cast("double").alias("score"), F.lit(None).alias("signals"), chunk["text"].alias("prepared")))
        return F.when(chunk["tag"], tag).otherwise(out)

    # Rows

    def heal(self, df: DataFrame, text: str = "raw_text", path: str | None = "field_path", family_col: str | None = None) -> DataFrame:
        """df with family, prior, segments, prepared_text, html, repairs_applied, failure_reasons, buckets, had_math, had_fallback, row_outcome.

        A null text counts as empty, gives no segments and bucket Z. An HTML row is cut at its tags; known tags pass
        verbatim and each stretch of prose is healed by itself.
        """
        raw = F.coalesce(F.col(text), F.lit(""))
        found = family(F.col(path)) if path else F.lit("unknown")
        if family_col:
            found = F.when(F.coalesce(F.col(family_col), F.lit("")) != "", F.col(family_col)).otherwise(found)
        df = df.withColumn("family", found).withColumn("prior", prior(F.col("family"), self.priors)).withColumn("is_html", raw.rlike(D.HTML_ROUTE))
        df = df.withColumn("_chunks", F.transform(F.transform(self._chunks(raw, F.col("is_html")), lambda c: self._global(c, F.col("prior"), F.col("is_html"))), self._wrapped))
        df = df.withColumn("segments", F.flatten(F.transform("_chunks", lambda c: self._segments(c, F.col("prior")))))
        each = lambda name: F.flatten(F.transform("segments", lambda s: s[name]))
        html = F.transform("segments", lambda s: F.when(s["kind"] == "html", s["prepared"]).otherwise(self._html(s)))
        df = df.withColumn("prepared_text", F.array_join(F.transform("segments", lambda s: s["prepared"]), "")).withColumn("html", F.array_join(html, ""))
        df = df.withColumn("repairs_applied", F.concat(F.flatten(F.transform("_chunks", lambda c: c["repairs"])), each("repairs"))).withColumn("failure_reasons", each("reasons"))
        of = lambda o: F.exists("segments", lambda s: s["outcome"] == o)
        df = df.withColumn("had_math", of("math")).withColumn("had_fallback", of("fallback"))
        df = df.withColumn("row_outcome", F.when(F.col("had_fallback"), "fallback").when(F.col("had_math"), "math").otherwise("text"))
        label = F.when(F.col("is_html"), raw).otherwise(F.coalesce(F.get(F.transform("_chunks", lambda c: c["text"]), F.lit(0)), F.lit("")))
        return df.withColumn("buckets", self.buckets(label)).drop("_chunks")

    def buckets(self, text: Column) -> Column:
        """Sorted labels of a healed row (columns segments, repairs_applied, failure_reasons); Z if there is none."""
        mapping = D.REPAIR_BUCKETS | self.repair_buckets
        by_repair = F.transform("repairs_applied", lambda r: F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), r))
        some = lambda test: F.exists("segments", test)
        flag = lambda test: F.coalesce(test, F.lit(False))
        why = lambda test: F.exists("failure_reasons", test)
        math = some(lambda s: s["outcome"] == "math")
        tests = [
            (why(lambda r: r.contains("brace") & ~r.startswith("forbidden_command")), "B"), (unescaped_dollars(text) % 2 == 1, "C"), (some(lambda s: flag(F.size(s["signals"]["corruption"]) > 0)), "D"), (why(lambda r: r.startswith("forbidden_command")), "E"),
            (some(lambda s: (s["kind"] == "html") | flag(s["signals"]["html"])) | text.rlike(D.TABLE_TAG), "F"), (math & some(lambda s: (s["outcome"] == "text") & (strip(s["original"]) != "")), "G"), (why(lambda r: r == "subscript_run_too_long"), "H"),
            (text.rlike(D.CODE_FENCE) | text.rlike(D.CODE_SPAN), "I"), (text.rlike(D.CURRENCY_ROW) | (~math & text.rlike(D.CURRENCY_ANYWHERE)), "J"),
            (some(lambda s: (s["outcome"] == "math") & s["repaired"].rlike(D.NESTED_TEXT)), "K"), (text.rlike(D.LITERAL_NEWLINE), "L"),
        ]
        found = F.array_sort(F.array_distinct(F.array_compact(F.concat(by_repair, S.names(*tests)))))
        return F.when(F.size(found) == 0, F.array(F.lit("Z"))).otherwise(found)


def arrow(function: Callable[[str], str]) -> Callable[[Column], Column]:
    """A `str -> str` plug-in as an Arrow UDF for whole text columns; a text it fails on stays as it is."""

    @F.pandas_udf("string")
    def run(texts):
        def safe(t):
            try:
                return function(t)
            except Exception:
                return t

        return texts.map(safe, na_action="ignore")

    return run


def heal(df: DataFrame, **names) -> DataFrame:
    return Engine().heal(df, **names)
