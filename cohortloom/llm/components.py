"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortloom.llm.workspace import Workspace


def connected_components(work: Workspace, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for each node of ``edges`` but the roots; the root is the least node.

    Each round links the larger neighbours of every node to its least one, then
    the smaller ones; the number of rounds grows with the logarithm of the
    longest chain. Least neighbours come from aggregates with partial results
    before the shuffle, so a node that a third of all edges meet is no hot
    group; the joins back are ordinary ones, which adaptive execution splits.
    Each round is written. Without edges there are no rows.
    """
    current, state = _cut(
        work, edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).filter("node <> root").distinct()
    )
    while state[0]:
        both = current.unionByName(current.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = (
            both.filter("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        ).distinct()
        large = work.cut(large)
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        lower = large.join(low, "node").filter("root <> low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        old, before = current, state
        current, state = _cut(work, low.withColumnRenamed("low", "root").unionByName(lower).distinct())
        work.forget(old)
        work.forget(large)
        if state == before:
            break
    return current


def _cut(work: Workspace, edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """Written edges, and their number and a sum over them, which the write itself observes."""
    seen = Observation()
    hashed = F.xxhash64("node", "root").bitwiseAND(F.lit((1 << 31) - 1))
    cut = work.cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(hashed), F.lit(0)).alias("sum")))
    return cut, (seen.get["n"], seen.get["sum"])
