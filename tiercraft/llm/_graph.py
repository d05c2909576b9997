"""Connected components of a table of links, by alternating star steps; every step is joins and sums in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, root) for every vertex with a link; root is the smallest vertex of its component.

    A large step ties the larger neighbours of every vertex to its smallest neighbour, a small step the smaller ones,
    until nothing changes: a chain of n needs about log n rounds. Only a count and a checksum come to the driver.
    """
    x, y = F.greatest(a, b).alias("v"), F.least(a, b).alias("u")
    edges = stage(links.where(F.col(a) != F.col(b)).select(x, y).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("v").alias("vertex"), F.col("u").alias("root")).unionByName(edges.select(F.col("u").alias("vertex"), F.col("u").alias("root")).distinct())
        before = now
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m"))
        large = both.join(least, F.col("v") == F.col("w")).where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.least("v", "m").alias("u")).distinct()
        large = stage(large, "edges")
        least = large.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m"))
        small = large.join(least, F.col("v") == F.col("w"))
        small = small.select(F.col("v"), F.col("m").alias("u")).unionByName(small.where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u")))
        edges = stage(small.distinct(), "edges")
