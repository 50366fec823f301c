"""Connected components of a large graph, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b): root is the smallest node it can reach.

    Large-star and small-star rounds: each node hands its smallest neighbour to its larger (then its
    smaller) ones, so paths shrink to stars in a logarithmic number of rounds. Each round is stored in
    the shared folder, which also cuts the lineage; a node's neighbours are never gathered, only their
    minimum is. Links of a node to itself and repeated links make no difference.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "links")
        # Sums of hashes tell whether the links still change.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
