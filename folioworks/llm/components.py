"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioworks.llm.common import staged


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) links that is not the smallest of its component.

    Alternates the two star contractions: every neighbour of a node is linked to the smallest neighbour, first the
    larger ones, then the smaller ones, until nothing changes. The number of rounds grows with the logarithm of the
    nodes. Minima are aggregated before their shuffle and joined back as one row per node, so a node with very many
    links is no hot group; every round is a written table. Links with a null end or of a node to itself are left out.
    """
    links = (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    current = staged(links)
    seen = _fingerprint(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        current = staged(small)
        now = _fingerprint(current)
        if now == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
