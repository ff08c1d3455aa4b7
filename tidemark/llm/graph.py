"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of `edges` (a, b long); isolated nodes have no edges.

    Alternates two contractions until nothing changes. The large-star step hangs a node's larger neighbours on its
    smallest neighbour; the small-star step does that to the smaller ones. Both only group by node and keep minima, and
    the rounds grow with the logarithm of the longest chain; they end at the fixed point, without a limit. Loops and repeated edges are harmless.
    """
    rows = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    rows = cut(rows)
    before = None
    while True:
        rows = cut(_small_star(_large_star(rows)))
        now = rows.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if now == before:
            break
        before = now
    top = rows.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
    roots = rows.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return top.unionByName(roots.join(top.select("node"), "node", "left_anti"))


def _large_star(rows: DataFrame) -> DataFrame:
    both = rows.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        rows.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return hung.filter("hi <> lo").distinct()


def _small_star(rows: DataFrame) -> DataFrame:
    least = rows.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    hung = rows.withColumnRenamed("hi", "u").join(least, "u").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    stars = least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    return hung.filter("hi <> lo").unionByName(stars).distinct()
