"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import forget, settled


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links (a, b: bigint) to (node, root): the least node reachable from each node that has a link.

    Every round moves each node's links to a smaller neighbour, so the rounds needed grow with the logarithm of a
    chain's length; a node's links meet only in a minimum, which Spark combines before it shuffles. Links of a node with
    itself, repeated links and nulls don't matter. Raises if most_rounds don't settle it.
    """
    edges = settled(links.filter("a is not null and b is not null and a != b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("to"))
        large = both.join(least, "n").filter("m > n").select(F.col("m").alias("n"), F.col("to").alias("m")).filter("n != m").distinct()
        least = large.groupBy("n").agg(F.min("m").alias("to"))
        joined = large.join(least, "n")
        small = joined.select(F.greatest("m", "to").alias("hi"), F.least("m", "to").alias("lo")).filter("hi != lo").unionByName(least.select(F.col("n").alias("hi"), F.col("to").alias("lo"))).distinct()
        old, edges = edges, settled(small.select("lo", "hi"), "edges")
        forget(old)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())
        if now == before:
            roots = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        before = now
    raise RuntimeError("components have not settled")
