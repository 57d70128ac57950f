"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregate and one join over the edges; stars are never
gathered, so a node with millions of edges is a partial aggregate and a join
that adaptive execution can split. Edges are written to the shared folder after
every round, which ends their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.where("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    own = least.select("u", F.col("m").alias("v"))
    return linked.union(own).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("long")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, tmp: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    ``edges`` are pairs of longs in any direction; loops, repeats and nulls do
    no harm. Rounds end when one changes nothing; their number grows with the
    logarithm of the longest path.
    """
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    now = tmp.store(edges.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct())
    before = _state(now)
    while before[0]:
        now = tmp.store(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.union(labels.select(F.col("component").alias("node"), "component").distinct())
