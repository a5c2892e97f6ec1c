"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a minimum per node (combined map-side) and a join on the node,
so a node with very many links is a skewed join key, never one task's group.
Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import write_read


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b).  Large: link every larger neighbour to the least; small: every smaller one."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        both = edges.join(least, "a")
        out = both.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp) for every node of ``links`` that is not its component's least id."""
    big, small = F.greatest(a, b), F.least(a, b)
    edges = write_read(links.select(big.alias("a"), small.alias("b")).where(F.col("a") > F.col("b")).distinct(), "links")
    mark = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == mark:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
        mark = tuple(seen)
        edges = write_read(_star(write_read(_star(edges, True), "links"), False), "links")
