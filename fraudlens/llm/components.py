"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """For each node of ``links(a, b)`` the smallest node it is connected with: (node, component).

    Rounds of two steps on links that point from a node to a smaller one. First every node's larger
    neighbours are pointed at its smallest neighbour, then its smaller neighbours are. Paths shorten to stars
    in a number of rounds that grows with the logarithm of their length; a round that changes nothing ends it.
    A node's neighbours are never gathered: its smallest one is a pre-aggregated minimum that is joined back.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = stage(pairs.distinct(), "component-links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        down = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "component-links")
        if after.select(_digest()).first() == pairs.select(_digest()).first():
            break
        pairs = after
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _digest():
    """Tells two sets of links apart by their number and sums of hashes."""
    hashed = F.xxhash64("u", "v")
    return F.struct(
        F.count(F.lit(1)), F.sum(hashed.cast("decimal(38,0)")), F.sum((hashed.bitwiseXOR(F.shiftright(hashed, 7))).cast("decimal(38,0)"))
    )
