"""Healing of streams: the row pipeline is stateless, so it is the same plan; telemetry counters are a streaming aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.engine import Engine


def heal_stream(lines: DataFrame, engine: Engine | None = None, text: str = "value") -> DataFrame:
    """Heals each non-empty line of a streaming DataFrame."""
    return (engine or Engine()).heal(lines.where(F.trim(text) != ""), text, None)


def counters(healed: DataFrame) -> DataFrame:
    """Counts by family, outcome and repair."""
    return healed.select("family", "row_outcome", F.explode_outer("repairs_applied").alias("repair")).groupBy("family", "row_outcome", "repair").count()
