"""Connected components of a link table, without any group in one task.

Large-star and small-star steps in turn: each step rewires a node's neighbours
to the smallest id seen, with one map-side-combined ``min`` and one join. The
join's large side is split by adaptive execution where a node is hot. Steps end
when the link table no longer changes; the number of steps grows with the
logarithm of the longest chain. Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) longs -> (node, component): the smallest node reachable.

    Only nodes that occur in a link to another node are returned. Null ends and
    links of a node to itself are ignored; direction and repeats don't matter.
    """
    e = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"),
                                         F.least("src", "dst").alias("v")).distinct()
    e = materialize(e, "cc")
    before = _state(e)
    while before[0]:
        e = materialize(_small_star(_large_star(e)), "cc")
        now = _state(e)
        if now == before:
            break
        before = now
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
