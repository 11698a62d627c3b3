"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge with the least neighbour of its first node.

    The minima are written first, so both sides of the join come straight from a
    shuffle and adaptive execution can split a node with very many edges.
    """
    least = staged(edges.groupBy("a").agg(F.min("b").alias("least")), "component-least")
    return edges.join(least, "a")


def _state(edges: DataFrame) -> tuple:
    """Tells two edge sets apart: their number and the sum of their hashes."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes"),
    ).first()
    return row.n, row.hashes


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b) that is not a root itself.

    The root is the least node of the component. Large-star and small-star steps
    alternate until each component is a star; every step writes its edges, whose
    number never grows. About the logarithm of the longest path's length in rounds.
    """
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "component-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _with_least(both)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        )
        large = staged(large.distinct(), "component-large")
        met = _with_least(large)
        small = met.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = staged(
            small.unionByName(met.select("a", F.col("least").alias("b"))).distinct(),
            "component-edges",
        )
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
