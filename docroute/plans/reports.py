"""Reports over resolved documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def routing_summary(resolved: DataFrame) -> DataFrame:
    """Documents per stage and queue.  A match with nothing to send counts
    under a NULL route; an error and no match under no stage at all."""
    return (
        resolved.filter("resolution is not null and resolution.error is null")
        .select("resolution.stage_key", F.explode_outer("resolution.sends.route").alias("route"))
        .groupBy("stage_key", "route")
        .agg(F.count("*").alias("n_docs"))
    )
