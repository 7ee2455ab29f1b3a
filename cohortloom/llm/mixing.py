"""Mixing sources to target weights by whole copies and one seeded extra copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What separates words: space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_DRAW_BITS = 52


def word_count(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, source_col: str, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3
) -> DataFrame:
    """Words each source should give: ``source, source_size, target, rate``.

    Sources ordered by code point, null last, take ``weights`` in turn and share
    the size of all. No target exceeds ``max_repeat`` times its source's size;
    the excess goes to the others by weight until none is above. With sources
    sorted by cap / weight this has a closed form: a source is capped if, with
    all before it capped, the rest shared by weight would still exceed its cap.
    All sums are integers, so the result does not depend on the order of rows.

    The two windows run over one row per source, after the aggregation.
    """
    totals = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("source_size"))
    big = "decimal(38,0)"
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    choice = F.array(*[F.lit(w).cast("long") for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.get(choice, place)).withColumn(
        "cap", max_repeat * F.col("source_size")
    )
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    ranked = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    capped = (F.col("total") - F.col("caps_before")).cast(big) * F.col("weight") > F.col("cap").cast(
        big
    ) * F.col("weight_left")
    flagged = ranked.withColumn("capped", capped)
    shared = flagged.select(
        "*",
        (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))).alias("rest"),
        F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything), F.lit(0)).alias("rest_weight"),
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("rest").cast(big) * F.col("weight")).cast("double") / F.col("rest_weight").cast("double")
    )
    return shared.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def seeded_draw(id_col: str, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digits = F.substring(F.md5(key), 1, _DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / float(2**_DRAW_BITS)


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeat: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Per row of ``docs``: ``doc`` (all its columns), ``size, source_size, target, copies``.

    A document is taken ``floor(rate)`` times, plus once more with the
    probability of the rate's fraction, drawn from a hash of id and seed, so a
    rerun and a retried task agree. Rows that repeat an id share its draw.
    A null or empty text has size 0 and is taken like any other of its source; a
    source without any words has rate 0. The columns of ``docs`` travel inside
    ``doc``, so their names cannot clash with the added ones. No rows give none.

    ``docs`` is read twice: to size the sources, and to be returned. A source
    that holds a third of all rows is pre-aggregated in the first pass; in the
    second the table of sources is broadcast if Spark finds it small, else joined
    by an ordinary sort-merge join, whose hot sources adaptive execution splits.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        (word_count() if size is None else size).alias("size"),
        F.col(source_col).alias("own_source"),
        seeded_draw(id_col, seed).alias("draw"),
    )
    targets = source_targets(sized, "own_source", weights, max_repeat)
    extra = F.when(F.col("draw") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return sized.join(targets, F.col("own_source").eqNullSafe(F.col("source"))).select(
        "doc", "size", "source_size", "target", (F.floor("rate") + extra).cast("int").alias("copies")
    )


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mixed documents: the columns of ``docs``, each row repeated ``copies`` times."""
    taken = plan_mix(docs, **options).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")
