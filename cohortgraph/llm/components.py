"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm.common import keep, unsent


def _smallest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges in both directions, and for each node the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both, both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that each end of ``edges`` (a, b longs, not null) reaches.

    Rounds of large stars and small stars: larger neighbours, then smaller ones, are hung on
    a node's smallest neighbour, until nothing moves; rounds grow with the logarithm of the
    size. Neighbours are reduced to their minimum before the shuffle and never gathered, so a
    node with very many is no hot group. Two numbers a round reach the driver,
    and nothing is broadcast.
    """
    found, before = keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None
    for _ in range(max_rounds):
        for large in (True, False):
            both, low = _smallest(found)
            kept = F.col("b") > F.col("a") if large else F.col("b") <= F.col("a")
            hung = both.join(unsent(low), "a").where(kept).select(F.col("b").alias("x"), F.col("low").alias("y"))
            if not large:
                hung = hung.unionByName(low.select(F.col("a").alias("x"), F.col("low").alias("y")))
            found = hung.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        found = keep(found, "edges")
        state = found.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = found.select(F.col("b").alias("id")).distinct()
    return found.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
