"""Connected components of links that Spark holds: contraction in rounds, no link or label on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node with a link to another; the component is its smallest id. Links of a node
    to itself and repeated links change nothing; null ends are ignored.

    Each round draws a random order; every node goes over to its first neighbour in it (or stays), twice, and
    links are rewritten. Expected rounds grow with the logarithm of the longest chain."""
    edges = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                   .where("a < b and a is not null").distinct(), "component-edges")
    mapping = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        other = F.struct(F.xxhash64(F.lit(turn), F.col("b")).alias("h"), F.col("b").alias("v"))
        best = both.groupBy("a").agg(F.min(other).alias("best"))
        own = F.struct(F.xxhash64(F.lit(turn), F.col("a")).alias("h"), F.col("a").alias("v"))
        up = stored(best.select(F.col("a").alias("id"), F.least("best", own).getField("v").alias("up")),
                    "component-up")
        above = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        up = stored(up.join(above, "up").select("id", F.col("top").alias("up")), "component-up")
        left = up.select(F.col("id").alias("a"), F.col("up").alias("ua"))
        right = up.select(F.col("id").alias("b"), F.col("up").alias("ub"))
        mapping = stored(up.select("id", F.col("up").alias("root")) if mapping is None else
                         mapping.join(up.select(F.col("id").alias("root"), "up"), "root", "left")
                         .select("id", F.coalesce("up", "root").alias("root")), "component-map")
        edges = stored(edges.join(left, "a").join(right, "b")
                       .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                       .where("a < b").distinct(), "component-edges")
        turn += 1
    if mapping is None:
        return edges.select(F.col("a").cast("long").alias("id"), F.col("b").cast("long").alias("component"))
    smallest = stored(mapping.groupBy("root").agg(F.min("id").alias("component")), "component-smallest")
    return mapping.join(smallest, "root").select("id", "component")
