"""Connected components over an edge table, as rounds of joins (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import discard, materialize_narrow


def _done(star: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, or only larger ones: then the edges are the answer."""
    ends = star.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return not ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").take(1)


def components(edges: DataFrame, name: str = "graph") -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b; long): comp is the smallest node reachable.

    A round lets every node's larger neighbours point to its smallest one, then its smaller ones; edges only
    ever shrink towards stars. A hub's minimum is pre-aggregated, written and joined back, so a hub with a
    third of all edges is a skewed join that Spark can split. Every round is written to the shared folder.
    """
    star = materialize_narrow(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not _done(star):
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize_narrow(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = materialize_narrow(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        low2 = materialize_narrow(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(low2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = materialize_narrow(small.filter("u <> v").distinct(), name)
        for old in (low, large, low2, star):
            discard(old)
        star = after
    return star.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
