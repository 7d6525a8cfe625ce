"""Connected components of a link table by alternating star contraction.

Large star: every node links its larger neighbours to the smallest node of its
neighbourhood; small star: every node links its smaller neighbours and itself
to the smallest of them. Repeated until nothing changes, every node points at
the smallest node of its component. Each step is two aggregations with map-side
reduction and joins that AQE can split, so a node with many links is no
hot spot; links stay in tables of the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _fingerprint(edges: DataFrame) -> tuple:
    half = F.shiftright(F.xxhash64("u", "v"), 20)
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(half)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node of a link between different nodes,
    the smallest node that it reaches. Null ends and self links are ignored."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
             .distinct())
    edges = written(edges, "component-links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("low").alias("v"))))
                         .alias("e"))
                 .select("e.*").where("u != v").distinct())
        edges = written(small, "component-links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
