"""Connected components by alternating large-star and small-star rounds; nothing is gathered on the driver but whether any is left open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _stars(own: DataFrame) -> bool:
    """Whether each `hi` has one edge and is no edge's `lo`: then each component is a star around its smallest node."""
    ends = own.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(own.select("lo", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node of its component.

    Null ends and loops are ignored (a node with only loops is not returned); repeated edges count once. A round costs two
    joins of the edge list with one row per node, whose large keys AQE splits; the number of rounds grows with the
    logarithm of the longest path. Edges that are stars already, as an earlier call's (node, root) are, cost no round, so new
    edges are best added to those. Raises if `max_rounds` do not suffice.
    """
    own = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    own = common.table(own.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    for _ in range(max_rounds):
        if _stars(own):
            roots = own.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("root"))
            out = common.table(own.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots))
            common.forget(own)
            return out
        both = own.union(own.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("m", "hi").alias("m"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = common.table(large.union(least.where("hi <> m").select("hi", F.col("m").alias("lo"))).distinct())
        small_least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(small_least, "hi").where("lo <> m").select(F.greatest("lo", "m").alias("hi"), F.least("lo", "m").alias("lo"))
        before, own = own, common.table(small.union(small_least.select("hi", F.col("m").alias("lo"))).distinct())
        common.forget(before, large)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
