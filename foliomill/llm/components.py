"""Connected components of a link table, without a link leaving the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, scratch


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (its least reachable node) of every node in links (a, b: long).

    Large-star and small-star steps in turn: each node ties its larger (then its
    smaller) neighbours to its least one, until nothing changes.  A step is
    linear in the links, and the number of steps grows with the logarithm of the
    longest path.  Links with a null end and loops are ignored.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        with scratch(links.sparkSession):
            large = cut(large, "large-star")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            tied = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = tied.where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
            edges = cut(small, "small-star", stays=True)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
