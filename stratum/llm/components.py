"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its smallest node.

    A large-star step links each node's larger neighbours to its smallest one, a small-star step its
    smaller neighbours; a few rounds, logarithmic in the size of a component, leave stars.  Each step
    is a map-side combined minimum and an equi-join, so a node with many neighbours needs no group of
    its own; the edges of a round are a table in the shared folder.  Null nodes and loops are left
    out of the steps; a node that only has a loop is a component.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    edges = cut_lineage(edges.distinct(), "edges")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    stars, before = edges.where("a != b"), None
    while True:
        both = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(lowest, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        stars = cut_lineage(small.distinct(), "stars")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    named = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node")).unionByName(loops).distinct().join(named.select("node"), "node", "left_anti")
    return named.unionByName(roots.select("node", F.col("node").alias("component")))
