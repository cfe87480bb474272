"""Connected components of an undirected graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the root is the least node of the component.

    Large-star and small-star rounds: every node links its neighbours to the least of them, which halves paths, until
    nothing changes.  A round is two joins on nodes; the edges stay in number.  Tables are stored before they are joined, so
    that the edges of a node that most others link to can be split.
    """
    graph = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), name)
    before = _state(graph)
    while True:
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        least = stored(least, f"{name}-least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = stored(large, f"{name}-large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), f"{name}-low")
        small = large.join(low, "a")
        linked = small.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        graph = stored(linked.unionByName(low.select("a", F.col("low").alias("b"))).where("a != b").distinct(), name)
        now = _state(graph)
        if now == before:
            break
        before = now
    roots = graph.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return graph.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(graph: DataFrame) -> tuple:
    """Number and sum of the edges' hashes: equal only when the edges are."""
    return tuple(graph.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
