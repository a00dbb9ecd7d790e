"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.session import stage


def _dealt(least: DataFrame) -> DataFrame:
    """The same rows, with an exchange of their own in a join: only then can Spark split the edges of a hub.

    The key is negated twice, so that Spark does not take the rows for dealt by it already.
    """
    return least.select(F.bitwise_not(F.bitwise_not("a")).alias("a"), "m")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` of every node of ``links(a, b)``; the component is its smallest node.

    Each round joins edges with the least neighbour of one end: minima are
    aggregated before the shuffle and adaptive execution splits the edges of
    a hub. Rounds are written to the shared folder, which cuts the lineage.
    Links with a null end and loops are left out.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), name)
    last = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = _dealt(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = stage(large, name)
        least = _dealt(edges.groupBy("a").agg(F.min("b").alias("m")))
        small = (edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, name)
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == last:
            break
        last = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b").distinct()))
