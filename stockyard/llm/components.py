"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) for every linked node.

    ``links`` has long columns ``a`` and ``b``. Each round replaces the links
    of a node by links to its smallest neighbour (first among larger
    neighbours, then among smaller ones), until nothing changes; the link
    count never grows, whatever the degree of a node. A checkpoint cuts the
    lineage each round. Links of a node to itself are ignored.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                         F.least("a", "b").alias("v")).distinct().checkpoint()
    before = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        # Larger neighbours go to the smallest of the node's neighbours and itself.
        large = both.join(low, "u").where("v > u") \
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # Smaller neighbours, and the node, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pairs = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
