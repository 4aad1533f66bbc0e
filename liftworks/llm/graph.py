"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from liftworks.sources import stage


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) with the smallest node reachable, for every node of ``edges`` (a, b).

    Large-star and small-star rounds: each node's neighbours are tied to its smallest neighbour,
    so a star of any size costs one row per neighbour, and chains halve. Each round is a written
    table. Self-loops and repeated or reversed edges do no harm.
    """
    pairs = edges.filter("a is not null and b is not null")
    pairs = stage(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        # larger neighbours of each node go to its smallest neighbour
        large = (
            both.join(least, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = stage(large.distinct(), "large_star")
        # smaller neighbours, and the node itself, go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        pairs = stage(small.filter("a != b").distinct(), "small_star")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components have not settled; raise max_rounds")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
