"""Finding and merging duplicate profiles.

Profiles that share a match value are duplicates; the one seen last is kept.
Only per-group maxima are computed and everything else is a join on
``distinct_id``, so a match value shared by a third of all profiles is no
bottleneck: its rows never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from ..session import cut_lineage

# Fixed value: property with the time a profile was last active.
LAST_SEEN = "$last_seen"


def match_value(prop: str = "$email", case_sensitive: bool = False) -> Column:
    """Text duplicates agree on; NULL (absent or null property) never matches."""
    text = P.prop_string("properties", prop)
    return text if case_sensitive else F.lower(text)


def _match_key(value: Column) -> Column:
    """A match value as a short key: long texts by their digest."""
    digest = F.concat(F.lit("#"), F.sha2(value, 256))
    return F.when(F.octet_length(value) > 64, digest).otherwise(F.concat(F.lit("="), value))


def _recency(order: str | None) -> Column:
    """Later is greater: last seen (missing = before all), input order, id."""
    seen = F.coalesce(
        P.prop_timestamp("properties", LAST_SEEN),
        F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"),
    )
    ties = [F.col(order).alias("tie")] if order else []
    return F.struct(seen.alias("seen"), *ties, F.col("distinct_id").alias("id"))


def _keyed(profiles: DataFrame, prop: str, case_sensitive: bool, order: str | None) -> DataFrame:
    """Profiles that have a match value, with how recent they are."""
    return profiles.select(
        "distinct_id",
        _match_key(match_value(prop, case_sensitive)).alias("_match"),
        _recency(order).alias("_recency"),
        "properties",
    ).where(F.col("_match").isNotNull())


def keepers(
    profiles: DataFrame,
    prop: str = "$email",
    case_sensitive: bool = False,
    order: str | None = None,
) -> DataFrame:
    """``_match, keeper_id, n``: the profile kept of each group of ids with one match value."""
    keyed = _keyed(profiles, prop, case_sensitive, order).drop("properties")
    return keyed.groupBy("_match").agg(
        F.max("_recency")["id"].alias("keeper_id"), F.count(F.lit(1)).alias("n")
    )


def duplicate_ids(
    profiles: DataFrame,
    prop: str = "$email",
    case_sensitive: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Ids to delete: those with a match value that are not their group's keeper."""
    kept = keepers(profiles, prop, case_sensitive, order)
    return _losers(profiles, prop, case_sensitive, order, kept).select("distinct_id").distinct()


def _losers(
    profiles: DataFrame, prop: str, case_sensitive: bool, order: str | None, kept: DataFrame
) -> DataFrame:
    """``distinct_id, _match, _recency`` of all but the keepers, from groups of several ids.

    Most profiles match no other: they leave with their group's count, so the
    joins that follow see the duplicates only.
    """
    groups = kept.where(F.col("n") > 1).select("_match", "keeper_id")
    keyed = _keyed(profiles, prop, case_sensitive, order).drop("properties")
    return keyed.join(groups, "_match").where(F.col("distinct_id") != F.col("keeper_id")).drop("keeper_id")


def merged_properties(
    profiles: DataFrame,
    prop: str = "$email",
    case_sensitive: bool = False,
    order: str | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """``distinct_id`` of each keeper and its duplicates' properties, the newest winning.

    ``$last_seen`` is left out. One value per group and property is kept while
    aggregating, never a list of profiles. ``kept`` is the result of
    :func:`keepers` if it is at hand.
    """
    if kept is None:
        kept = keepers(profiles, prop, case_sensitive, order)
    losers = _losers(profiles, prop, case_sensitive, order, kept).join(
        profiles.select("distinct_id", "properties"), "distinct_id"
    )
    newest = (
        P.explode_props(losers, "_match", "_recency")
        .where(F.col("name") != LAST_SEEN)
        .groupBy("_match", "name")
        .agg(F.max_by("text", "_recency").alias("text"))
    )
    maps = newest.groupBy("_match").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("value")
    )
    return kept.where(F.col("n") > 1).join(maps, "_match").select(
        F.col("keeper_id").alias("distinct_id"), "value"
    )


def deduplicate(
    profiles: DataFrame,
    prop: str = "$email",
    merge_props: bool = False,
    case_sensitive: bool = False,
    order: str | None = None,
    only_truthy: bool = False,
) -> DataFrame:
    """Profiles without duplicates.

    ``merge_props`` gives the keeper the properties only its duplicates have.
    ``only_truthy`` limits the search to profiles whose match property is
    truthy, as when no list of profiles is given. ``order`` names a column
    that breaks ties of ``$last_seen`` (greater = later); the id breaks the rest.
    """
    searched = match_value(prop, case_sensitive).isNotNull() & F.col("distinct_id").isNotNull()
    if only_truthy:
        searched = searched & Q.truthy("properties", prop)
    pool = profiles.where(searched)
    # Groups of several ids only: found once and written, one short row per match value.
    kept = cut_lineage(keepers(pool, prop, case_sensitive, order).where(F.col("n") > 1), "keepers")
    losers = _losers(pool, prop, case_sensitive, order, kept).select("distinct_id")
    left = profiles.join(losers, "distinct_id", "left_anti")
    if not merge_props:
        return left.select(*profiles.columns)
    merged = merged_properties(pool, prop, case_sensitive, order, kept)
    joined = left.join(merged, "distinct_id", "left")
    filled = F.when(
        F.col("value").isNotNull(), P.set_once_props(F.col("properties"), F.col("value"))
    ).otherwise(F.col("properties"))
    return joined.withColumn("properties", filled).select(*profiles.columns)
