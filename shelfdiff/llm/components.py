"""Connected components of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.session import cut_lineage


def _nearest(edges: DataFrame) -> DataFrame:
    """node, low: the smallest of a node and its neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """node, root for every node with a link; root is the smallest node it can reach.

    Alternates two steps on links (b above a): every larger neighbour of a node is hung on the node's smallest one,
    then every node and its smaller neighbours are hung on the smallest of them. Both keep components as they are
    and end in stars, after a number of rounds that grows as the logarithm of the size. A node with very many links
    is met by joins, whose hot keys Spark splits, never gathered. Loops and repeated links do no harm; nodes must
    not be null. Each round is checkpointed.
    """
    links = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    links = cut_lineage(links)
    state = None
    for _ in range(rounds):
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return (links.select(F.col("b").alias("node"), F.col("a").alias("root"))
                    .unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()))
        state = tuple(seen)
        low = _nearest(links)
        larger = links.join(low, F.col("a") == F.col("node")).select(F.col("low").alias("a"), "b")
        # the smaller end of a link may itself have a smaller neighbour through its larger end
        hung = (links.join(low, F.col("b") == F.col("node")).filter("low <> a")
                .select(F.col("low").alias("a"), F.col("a").alias("b")))
        links = cut_lineage(larger.unionByName(hung).filter("a < b").distinct())
    raise RuntimeError(f"links are not settled after {rounds} rounds")
