"""Merkle manifest of a dataset: a tree of digests per group, one over the groups, and a proof per row.

1. Each row becomes a leaf, the digest of its fields; texts are not read again.
2. Rows are numbered within their group by a range sort, written once, and counts of partitions.
3. *Slot pivot*: the nodes of a level are grouped by their parent, and conditional
   aggregates spread the ``FANOUT`` children into as many columns. The digest of the
   columns put together is the parent; all columns but a child's own are its siblings.
   Each level is written; its size is a third of the one below.
4. From the roots down, each parent hands its own siblings and those above it
   to its children, so a row ends with its whole way to the root. Parents and their
   slots meet on (group, place), which both sides have once: no key is hot,
   whatever the size of a group.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm.workspace import Workspace

#: Children of a node; the last of a level may have fewer.
FANOUT = 3
_PATH = "array<struct<before:string,after:string>>"


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row's fields, each as its length in bytes, ``:`` and its text, or ``-`` if it is null."""
    texts = [f.cast("string") for f in fields]
    return digest_of(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(path, leaf, lambda node, level: digest_of(level["before"], node, level["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the way, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


@dataclass
class _Trees:
    """Trees over ``rows`` (``tree, place, n, digest, item``), and the written levels, lowest first.

    A level has a row per parent: ``tree, place, n`` (parents in its tree), the ``slots``
    of its children, ``digest``.
    """

    rows: DataFrame
    levels: list[DataFrame] = field(default_factory=list)

    def tops(self) -> DataFrame:
        """``tree, height, digest, item`` of the node that remains of each tree; above height 0 without an item."""
        found = self.rows.filter("n = 1").select("tree", F.lit(0).alias("height"), "digest", "item")
        for height, level in enumerate(self.levels, 1):
            top = level.filter("n = 1").select("tree", F.lit(height).alias("height"), "digest")
            found = found.unionByName(top, allowMissingColumns=True)
        return found

    def paths(self, above: DataFrame) -> DataFrame:
        """``item, digest, path`` and the columns of ``above`` for each row.

        ``above`` has a row per tree: ``tree, height, path`` (what is above its top node)
        and columns to hand down.
        """
        handed = [c for c in above.columns if c not in ("tree", "height", "path")]
        begin = above.withColumn("place", F.lit(0).cast("long"))
        current = begin.limit(0).drop("height")
        for height in range(len(self.levels), 0, -1):
            current = current.unionByName(begin.filter(F.col("height") == height).drop("height"))
            children = F.filter(
                F.array(*[F.struct(F.lit(i).alias("slot"), F.get("slots", F.lit(i)).alias("node")) for i in range(FANOUT)]),
                lambda child: child["node"].isNotNull(),
            )
            digests = lambda test: F.array_join(
                F.transform(F.filter(F.col("children"), test), lambda c: c["node"]["digest"]), ""
            )
            slot = F.col("child.slot")
            own = F.struct(digests(lambda c: c["slot"] < slot).alias("before"), digests(lambda c: c["slot"] > slot).alias("after"))
            current = (
                self.levels[height - 1]
                .select("tree", "place", children.alias("children"))
                .join(current, ["tree", "place"])
                .select("*", F.explode("children").alias("child"))
                .select(
                    "tree",
                    (F.col("place") * FANOUT + slot).alias("place"),
                    F.concat(F.array(own), "path").alias("path"),
                    *handed,
                    "child.node",
                )
            )
            if height > 1:
                current = current.drop("node")
        single = begin.filter("height = 0").join(self.rows.filter("n = 1").select("tree", "digest", "item"), "tree")
        single = single.select("item", "digest", "path", *handed)
        if not self.levels:
            return single
        return current.select("node.item", "node.digest", "path", *handed).unionByName(single)


def _numbered(work: Workspace, rows: DataFrame, order_by: list[str]) -> DataFrame:
    """``rows`` with their ``place`` in their ``tree``, from 0 in the order given, and its size ``n``.

    Written once after the sort, with partition and place in it; what each
    partition has of each tree gives the rest, at most a row per tree and partition.
    """
    sort_by = ["tree", *order_by]
    placed = work.cut(
        rows.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).withColumn("at", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("tree", "part").agg(F.count("*").alias("n_run"), F.min("at").alias("first"))
    of_tree = W.partitionBy("tree")
    before = F.sum("n_run").over(of_tree.orderBy("part")) - F.col("n_run")
    offsets = runs.select(
        "tree", "part", (before - F.col("first")).alias("shift"), F.sum("n_run").over(of_tree).alias("n")
    )
    return work.cut(placed.join(offsets, ["tree", "part"]).select("tree", (F.col("at") + F.col("shift")).alias("place"), "n", "digest", "item"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The level above ``nodes``: their parents with the children in slots; trees of one node are done."""
    own = F.struct(*[c for c in ("digest", "item") if c in nodes.columns])
    slot = F.col("place") % FANOUT
    spread = [F.any_value(F.when(slot == i, own), ignoreNulls=True).alias(f"slot_{i}") for i in range(FANOUT)]
    columns = [F.col(f"slot_{i}") for i in range(FANOUT)]
    return (
        nodes.filter("n > 1")
        .groupBy("tree", F.expr(f"place div {FANOUT}").alias("parent"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"))
        .agg(*spread)
        .select(
            "tree",
            F.col("parent").alias("place"),
            "n",
            F.array(*columns).alias("slots"),
            digest_of(*[F.coalesce(c["digest"], F.lit("")) for c in columns]).alias("digest"),
        )
    )


def _grow(work: Workspace, rows: DataFrame, order_by: list[str]) -> _Trees:
    """All levels of the trees over ``rows``, until each tree has one node."""
    trees = _Trees(_numbered(work, rows, order_by))
    nodes, widest = trees.rows, trees.rows.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        level = work.cut(_parents(nodes))
        trees.levels.append(level)
        nodes, widest = level.select("tree", "place", "n", "digest"), -(-widest // FANOUT)
    return trees


def merkle_manifest(
    work: Workspace,
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    id_col: str = "doc_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``id_col, group_col, leaf, subroot, root, path`` and the columns of ``carry``.

    The leaf is the digest of ``fields``. In each group the leaves, by ascending id,
    are the lowest level of a tree; every ``FANOUT`` consecutive nodes, the last ones of
    a level perhaps fewer, become one until the ``subroot`` remains. Subroots, by
    group, are the lowest level of the tree that ends in ``root``. ``path`` has for each level
    from the leaf to the root the digests ``before`` and ``after`` the row's node in its run,
    put together as text, so :func:`fold` leads from a leaf to the root.

    A null group is one of its own, before all others; null ids come first in their
    group. Rows that share group and id go by their leaf; rows equal in all fields
    have equal leaves, so the trees do not depend on which comes first. A row that
    is alone in its group is its subroot, and a single group's subroot the root. No rows
    give none. Columns not named are not read.
    """
    carried = carry or {}
    item = F.struct(F.col(id_col).alias("id"), F.col(group_col).alias("group"), *[c.alias(f"_{k}") for k, c in carried.items()])
    leaves = work.cut(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
            leaf_digest(*map(F.col, fields)).alias("digest"),
            item.alias("item"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    groups = _grow(work, leaves.withColumn("id", F.col("item.id")), ["id", "digest", "tie"])
    tops = work.cut(groups.tops().drop("item"))
    named = tops.select(
        F.lit("").alias("tree"), "digest", F.struct(F.col("tree").alias("group"), "height").alias("item"), F.col("tree").alias("name")
    )
    whole = _grow(work, named, ["name"])
    root = whole.tops().select("tree", "height", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    above = work.cut(
        whole.paths(root).select(
            F.col("item.group").alias("tree"), F.col("item.height").alias("height"), F.col("digest").alias("subroot"), "root", "path"
        )
    )
    return work.result(
        groups.paths(above).select(
            F.col("item.id").alias(id_col),
            F.col("item.group").alias(group_col),
            F.col("digest").alias("leaf"),
            "subroot",
            "root",
            "path",
            *[F.col(f"item._{k}").alias(k) for k in carried],
        )
    )
