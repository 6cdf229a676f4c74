"""Connected components of a graph given by its edges, by joins.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step
hangs neighbours onto the smallest node known, in one grouping and one join, and
a few rounds flatten any graph to stars.  Every round is a table in the shared
folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.tables import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges run from the larger node u to a smaller v.
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    ).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (u, v); the component is its
    smallest node."""
    now = cut_lineage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )
    state = None
    while True:
        now = cut_lineage(_small_star(_large_star(now).distinct()))
        n, check = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (n, check) == state:
            break
        state = n, check
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
