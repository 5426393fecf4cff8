"""Connected components of a graph that is only ever a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.staging import stage


def _stars(pairs: DataFrame) -> bool:
    """Whether every node points to one lesser node, which points to none."""
    ends = pairs.select(F.col("hi").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        pairs.select("lo", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component_id)`` of every id that a link between different ids names.

    Links point each node to its least neighbour, by turns over all neighbours
    and over the lesser ones, until every component is a star around its least
    id: a number of rounds that grows with the logarithm of the size. Each round
    is a written table, so a lost executor costs one round. A node with many
    links is counted before the shuffle.
    """
    pairs = links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    pairs = stage(pairs, "links")
    while not _stars(pairs):
        both = pairs.union(pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        # written, so that Spark can split the other side of the join at a node with very many links
        least = stage(both.groupBy("lo").agg(F.least(F.col("lo"), F.min("hi")).alias("least")), "least")
        wide = both.where("hi > lo").join(least, "lo").select(F.col("least").alias("lo"), "hi").distinct()
        wide = stage(wide, "wide")
        least = wide.groupBy("hi").agg(F.min("lo").alias("least"))
        narrow = wide.join(least, "hi").where("lo > least").select(F.col("least").alias("lo"), F.col("lo").alias("hi"))
        pairs = stage(narrow.union(least.select(F.col("least").alias("lo"), "hi")).distinct(), "links")
    hubs = pairs.select(F.col("lo").alias("id")).distinct()
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).union(
        hubs.select("id", F.col("id").alias("component_id"))
    )
