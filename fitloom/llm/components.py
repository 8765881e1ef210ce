"""Connected components of a link table, as alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.session import materialise


def _state(edges: DataFrame) -> tuple:
    """Count and order-free hash sum of a link table: equal states mean equal tables."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is the least node reachable.

    Each round replaces links by links to smaller nodes, so a chain of n nodes needs about
    log n rounds. A node with very many links is only ever joined on, never gathered: its
    minimum is a partial aggregate and adaptive execution may split its side of the join.
    Every round is a written table in the shared folder, so lost executors cost one round.
    Links of a node to itself and rows with a null end are ignored.
    """
    ordered = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialise(ordered.distinct(), name)
    before = _state(edges)
    while True:
        around = edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        least = around.select("node", F.least("node", "m").alias("m"))
        large = edges.join(least, edges.b == least.node).select("a", F.col("m").alias("b")).distinct()
        large = materialise(large, name)
        lowest = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        moved = large.join(lowest, large.a == lowest.node).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(moved.union(lowest).distinct(), name)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
