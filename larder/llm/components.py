"""Connected components of an edge table by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``name`` for each node of the edges (``a``, ``b``, longs); the name is the least node reachable.

    Large-star links every larger neighbour of a node to the least one around it,
    small-star every smaller one; the edges turn into stars in a number of rounds
    that grows with the logarithm of the longest path. Each round is written, so joins read
    plain tables whose hot keys can be split, and a lost executor costs no earlier round.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = stage(pairs), None
    while True:
        # large star
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "n"))
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where(F.col("a") != F.col("b")).distinct())
        # small star
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"))
        small = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        pairs = stage(small.where(F.col("a") != F.col("b")).distinct())
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("name")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("name")).distinct())
