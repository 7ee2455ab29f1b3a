"""Counting events, and writing counts back to profiles.

Counts combine on the map side: what is shuffled is one row per user and event
name and map task, so a user with a third of all events is no heavier than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import properties as P
from . import updates as U


def count_per_event(events: DataFrame) -> DataFrame:
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("n"))


def count_per_user_event(events: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Events per user and name, for users with a profile if ``profiles`` is given.

    Counted before the join, so the join sees the small side of both.
    """
    counts = events.groupBy("distinct_id", "event").agg(F.count(F.lit(1)).alias("n"))
    if profiles is None:
        return counts
    return counts.join(profiles.select("distinct_id"), "distinct_id", "left_semi")


def count_per_day(events: DataFrame, day: str = "day") -> DataFrame:
    return events.groupBy(day).agg(F.count(F.lit(1)).alias("n"))


def event_counts_to_profiles(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Set ``{event name: count}`` on every profile that has events.

    A count map has one entry per event name of a user, never one per event.
    Events without a name count for no property.
    """
    counts = (
        count_per_user_event(events.where(F.col("event").isNotNull()))
        .groupBy("distinct_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("event", F.col("n").cast("string").alias("text")))
            ).alias("value")
        )
    )
    return U.update_from_rows(profiles, counts, U.SET, create=False)


def property_catalog(items: DataFrame) -> DataFrame:
    """Each property name with the number of items that carry it."""
    return (
        P.explode_props(items, key="property")
        .groupBy("property")
        .agg(F.count(F.lit(1)).alias("n"))
    )
