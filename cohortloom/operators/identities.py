"""Identity clusters: every id of a chain of merges to one canonical id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .joins import HOT_ROWS, lookup_join, resolve_alias


def _flattened(parents: DataFrame, hot_rows: int) -> DataFrame:
    """``id, parent`` with each parent a root, by jumping over it to its own parent.

    Every jump doubles what a step covers, so a chain of ``n`` ids takes ``log2(n)``.
    """
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        jumped = cut_lineage(
            lookup_join(parents, above, ["parent"], "left", hot_rows=hot_rows, salt=["id"]).select(
                "id", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            ),
            "jump",
        )
        parents = jumped.select("id", "parent")
        if jumped.where("moved").isEmpty():
            return parents


def identity_clusters(
    pairs: DataFrame, a: str = "id_a", b: str = "id_b", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``distinct_id, canonical_id`` of all ids in ``pairs``; the canonical id is the least of its cluster.

    Ids are in one cluster if pairs join them, over whatever chain or cycle. A pair
    with a null on either side joins nothing; its other id is a cluster of its own if no pair
    holds it. Every round hooks each root to the least root it is paired with, flattens
    the chains that makes by pointer jumping, and replaces the ids of pairs by
    their roots; pairs within one root go. Ids of many pairs are dealt over tasks
    (:func:`.joins.lookup_join`), least neighbours combine on the map side.
    """
    ids = pairs.select(F.explode(F.array(a, b)).alias("id")).where("id IS NOT NULL").distinct()
    roots = cut_lineage(ids.select("id", F.col("id").alias("root")), "roots")
    ends = [F.col(c).cast("string") for c in (a, b)]
    links = cut_lineage(pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).where("a < b").distinct(), "links")
    while not links.isEmpty():
        # Both are known only by the lesser end: the greater one hooks, roots only ever to lesser ones.
        hooked = links.groupBy("b").agg(F.min("a").alias("parent")).withColumnRenamed("b", "id")
        parents = _flattened(cut_lineage(hooked, "hooks"), hot_rows)
        as_root = parents.select(F.col("id").alias("root"), F.col("parent").alias("found"))
        roots = cut_lineage(
            lookup_join(roots, as_root, ["root"], "left", hot_rows=hot_rows, salt=["id"]).select(
                "id", F.coalesce("found", "root").alias("root")
            ),
            "roots",
        )
        for end in ("a", "b"):
            named = parents.select(F.col("id").alias(end), F.col("parent").alias("found"))
            links = lookup_join(links, named, [end], "left", hot_rows=hot_rows, salt=["a", "b"]).withColumn(
                end, F.coalesce("found", end)
            ).drop("found")
        links = cut_lineage(
            links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links"
        )
    return roots.select(F.col("id").alias("distinct_id"), F.col("root").alias("canonical_id"))


def merge_identities(
    df: DataFrame, clusters: DataFrame, id_col: str = "distinct_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows with the canonical id of their cluster; ids in no cluster stay."""
    aliases = clusters.where("distinct_id <> canonical_id").withColumnRenamed("distinct_id", "alias")
    return resolve_alias(df, aliases, id_col=id_col, hot_rows=hot_rows)
