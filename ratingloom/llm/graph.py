"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import BROADCAST_ROWS, staged


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node) of every node of ``edges`` (a, b: two bigint).

    Alternates large-star and small-star: each hooks the neighbours of a node to the
    smallest of them, so diameters shrink geometrically and edges never multiply. Edges few
    enough to be broadcast stay in one partition, so that no round shuffles them.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = staged(edges, "edges")
    few = edges.count() <= BROADCAST_ROWS

    def dealt(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if few else df

    def to_least(edges: DataFrame, name: str) -> DataFrame:
        """``edges`` with the least b of each a; both inputs are tables, so AQE splits a hot a."""
        least = dealt(staged(edges.groupBy("a").agg(F.min("b").alias("least")), f"{name}-least"))
        return edges.join(least, "a")

    edges = dealt(edges)
    before = None
    while (shape := _shape(edges)) != before:
        before = shape
        both = dealt(staged(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both"))
        large = to_least(both, "large").filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        hooked = to_least(dealt(staged(large.distinct(), "large")), "small")
        hooks = hooked.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            hooked.select("a", F.col("least").alias("b"))
        )
        edges = dealt(staged(dealt(hooks).filter("a <> b").distinct(), "edges"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return staged(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots), "components")
