"""Connected components, so that what depends on each other meets in one task and nothing else does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.session import by_shuffle, cut_lineage


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b: numbers); the root is the smallest node reached.

    Alternating stars: each round hangs the larger neighbours of a node on its smallest one, then a node and its
    smaller neighbours on the smallest of them, until every component is one star. Rounds grow as the logarithm of a
    component's size; a node with very many edges only meets joins, whose hot keys Spark splits. Every round is
    written, as it depends on all before it.
    """
    def directed(links: DataFrame) -> DataFrame:
        return links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()

    links = cut_lineage(directed(edges))
    fingerprint = None
    for _ in range(rounds):
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
        if now == fingerprint or not now[0]:
            roots = links.select(F.col("low").alias("node")).distinct().withColumn("root", F.col("node"))
            return links.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
        fingerprint = now
        both = (links.select(F.col("high").alias("node"), F.col("low").alias("other"))
                .unionByName(links.select(F.col("low").alias("node"), F.col("high").alias("other"))))
        least = both.groupBy("node").agg(F.min("other").alias("_least")).select("node", F.least("node", "_least").alias("least"))
        over = (links.join(by_shuffle(least.withColumnRenamed("node", "low")), "low").select(F.col("high").alias("a"), F.col("least").alias("b")))
        under = (links.join(by_shuffle(least.withColumnRenamed("node", "high")), "high").select(F.col("low").alias("a"), F.col("least").alias("b")))
        links = cut_lineage(directed(over.unionByName(under)))
    raise RuntimeError(f"components are not settled after {rounds} rounds")
