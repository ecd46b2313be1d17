"""Connected components by minimum labels and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import discard, stored


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node) for all nodes of links (a, b).

    A round takes the least label among a node and its neighbours, and then the label of that label; rounds end
    when no label changes. Labels only fall, so the fixed point is the smallest node of each component.
    """
    ways = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "ways")
    labels = stored(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = ways.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.least("component", F.coalesce("near", "component")).alias("next"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        new = stored(step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("component"), "was"), "labels")
        moved = new.where("component <> was").limit(1).count()
        discard(labels)
        labels = new
        if not moved:
            discard(ways)
            return labels.select("node", "component")
