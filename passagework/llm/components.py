"""Connected components of an edge table, without ever holding them in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it is linked with) of every node in ``edges`` (``a, b``).

    Large-star and small-star steps in turn. Each step takes the smallest neighbour by a pre-aggregated minimum and joins
    it back to the edges, so a node with very many neighbours is never gathered. Edges are written between rounds.
    """
    links = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    last = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # now every edge goes from the larger to the smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
