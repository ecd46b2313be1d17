"""Mixing sources to target weights: repetition rates from sizes a source, then whole copies and one seeded coin a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import unused

#: Weights repeat over the sources by code point, null last.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MOST = 3
SEED = 17


def size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(docs: DataFrame) -> DataFrame:
    """source, source_size, target for each source, sources few or many.

    All sources share the total by weight; a target beyond MOST times its source's size stops there and the excess is
    dealt anew, which ends at min(MOST * size, weight * level) for one level. In the order of MOST * size / weight
    the first sources are the stopped ones, so running sums give the level. If the caps hold less than
    the total (MOST < 1) all stop. Windows run over one row a source.
    """
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1).cast("long")).withColumn("cap", F.col("source_size") * MOST)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every, before = Window.partitionBy(), by_cap.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("rest_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    #: The first source, by cap, that its share of the rest doesn't fill sets the level.
    open_ = F.when(F.col("cap") * F.col("rest_weight") >= F.col("rest") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("rest"), F.col("rest_weight")))
    per = per.withColumn("level", F.min(open_).over(every))
    share = F.col("weight") * F.col("level.rest") / F.col("level.rest_weight")
    return per.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), share)).alias("target"))


def coin(seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on doc_id, the text and the seed, so that rows without an id of their own have different coins."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296)


def _rated(docs: DataFrame, seed: int) -> tuple[DataFrame, list[str]]:
    """docs with four more columns, and their names: size, source_size, target, copies. They clash with no name of docs."""
    names = [unused(docs, c) for c in ("_size", "_source_size", "_target", "_copies")]
    source = unused(docs, "_source")
    goal = targets(docs.select("source", size().alias("size"))).select(F.col("source").alias(source), F.col("source_size").alias(names[1]), F.col("target").alias(names[2]))
    out = docs.withColumn(names[0], size()).join(goal, F.col("source").eqNullSafe(F.col(source)), "left")
    rate = F.when(F.col(names[1]) > 0, F.col(names[2]) / F.col(names[1])).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (coin(seed) < rate - F.floor(rate)).cast("long")
    return out.withColumn(names[3], copies).drop(source), names


def mixing(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The columns of docs and size, source_size, target, copies, which replace docs' columns of these names.

    A null or empty text has size 0 and a source without words target 0 and no copies. Rows with one doc_id and
    one text share their coin; a null doc_id counts as an empty one. Sources are joined back by null-safe equality; one row a source, which Spark broadcasts by its own
    size check or else joins with skewed partitions split.
    """
    out, names = _rated(docs, seed)
    own = ("size", "source_size", "target", "copies")
    return out.select(*[c for c in docs.columns if c not in own], *(F.col(a).alias(b) for a, b in zip(names, own, strict=True)))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """docs with each row as often as the mix takes it: nulls, empty and repeated rows as in mixing(); an empty table gives none."""
    out, names = _rated(docs, seed)
    return out.where(F.col(names[3]) >= 1).withColumn(names[0], F.explode(F.sequence(F.lit(1), F.col(names[3]).cast("int")))).select(*docs.columns)


#: The same in DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(text, '')) AS text_md5 FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 AS INT) + 1] AS BIGINT) AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(cap) OVER b, 0) AS BIGINT) AS rest, CAST(sum(weight) OVER () AS BIGINT) - CAST(coalesce(sum(weight) OVER b, 0) AS BIGINT) AS rest_weight, row_number() OVER (ORDER BY cap / weight, encode(source) ASC NULLS LAST) AS place FROM w
  WINDOW b AS (ORDER BY cap / weight, encode(source) ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest, place) AS rest, arg_min(rest_weight, place) AS rest_weight FROM r WHERE cap * rest_weight >= rest * weight),
t AS (SELECT r.source, r.source_size, CASE WHEN l.rest IS NULL THEN CAST(r.cap AS DOUBLE) ELSE least(CAST(r.cap AS DOUBLE), CAST(r.weight * l.rest AS DOUBLE) / CAST(l.rest_weight AS DOUBLE)) END AS target FROM r, l),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate, CAST(('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.text_md5), 1, 8)) AS BIGINT) / 4294967296.0 AS coin FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN CAST(coin AS DOUBLE) < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
