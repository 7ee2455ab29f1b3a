"""Event operators: shaping, validity, projections and scans.

A raw event is ``event`` and ``properties`` (with ``distinct_id`` and ``time``
among the properties, as files carry them). A shaped event has ``event,
distinct_id, time, properties`` with ``time`` in epoch seconds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from ..functions import times as T

# Properties an imported event must carry.
REQUIRED = ("time", "distinct_id")


def scan_events(
    events: DataFrame,
    from_date: T.Day,
    to_date: T.Day,
    names=None,
    time_col: str = "time",
    unit: str = "s",
    event_col: str = "event",
    day_col: str | None = None,
) -> DataFrame:
    """Events of an inclusive day range, optionally of some names.

    Both conditions are on bare columns with literals, so they reach the
    Parquet scan. ``day_col`` names a date partition column, if the table has
    one; then other days are not even listed.
    """
    kept = events.where(T.in_days(time_col, from_date, to_date, unit))
    if day_col:
        low, high = (F.lit(T.as_day(d).isoformat()).cast("date") for d in (from_date, to_date))
        kept = kept.where(F.col(day_col).between(low, high))
    return kept if names is None else kept.where(Q.event_is(names, event_col))


def has_required(properties: Column | str = "properties") -> Column:
    """``time`` and ``distinct_id`` are there; an explicit null counts as there."""
    ok = F.lit(True)
    for name in REQUIRED:
        ok = ok & F.map_contains_key(P._col(properties), F.lit(name))
    return F.coalesce(ok, F.lit(False))


def tag_valid(raw: DataFrame) -> DataFrame:
    """Raw events with ``valid``; write the two sides from this one plan."""
    return raw.withColumn("valid", has_required())


def invalid_events(raw: DataFrame) -> DataFrame:
    """Raw events that may not be imported, unchanged."""
    return raw.where(~has_required())


def prepare_events(raw: DataFrame, token: str, offset_hours: float = 0) -> DataFrame:
    """Valid raw events ready for import: ``time`` shifted to UTC, ``token`` added.

    ``time`` may be a number or numeric text; a time that is neither becomes null.
    """
    shifted = T.to_utc(P.unquoted(P.prop("properties", "time")).try_cast("double"), offset_hours)
    stamp = F.create_map(
        F.lit("time"),
        F.coalesce(shifted.cast("string"), F.lit("null")),
        F.lit("token"),
        F.lit(P.literal_text(token)),
    )
    return raw.where(has_required()).withColumn("properties", P.overlay("properties", stamp))


def shape_events(raw: DataFrame) -> DataFrame:
    """Raw events to ``event, distinct_id, time, properties``."""
    return raw.select(
        "event",
        P.prop_string("properties", "distinct_id").alias("distinct_id"),
        P.unquoted(P.prop("properties", "time")).try_cast("double").cast("bigint").alias("time"),
        P.drop_props("properties", REQUIRED).alias("properties"),
    )


def raw_events(events: DataFrame, *keep: str) -> DataFrame:
    """Shaped events back to ``event, properties``; a property of the same name wins.

    ``keep`` names further columns to carry along.
    """
    time_type = events.schema["time"].dataType
    envelope = P.props_from_columns(
        {"distinct_id": ("distinct_id", "string"), "time": ("time", time_type)}
    )
    return events.select(
        "event", P.overlay(envelope, "properties").alias("properties"), *keep
    )


def shift_to_utc(events: DataFrame, offset_hours: float) -> DataFrame:
    """Shaped events with ``time`` moved from the project's zone to UTC."""
    return events.withColumn("time", T.to_utc("time", offset_hours))


def project_events(
    events: DataFrame,
    from_date: T.Day,
    to_date: T.Day,
    names=None,
    output_properties: Iterable[str] | None = None,
    offset_hours: float = 0,
    time_ms: str = "time_ms",
) -> DataFrame:
    """Query form of an event export.

    Reads ``event, distinct_id, time_ms, properties``. The result's ``time`` is in
    fractional seconds. ``distinct_id`` and ``time`` are taken over by a listed
    property of that name, as properties are copied after them.
    """
    kept = scan_events(events, from_date, to_date, names, time_ms, "ms")
    listed = REQUIRED if output_properties is None else list(output_properties)
    user, time = F.col("distinct_id"), T.query_time(time_ms, offset_hours)
    if "distinct_id" in listed:
        user = F.coalesce(P.prop_string("properties", "distinct_id"), user)
    if "time" in listed:
        time = F.coalesce(P.prop_number("properties", "time"), time)
    if output_properties is None:
        chosen = P.drop_props("properties", REQUIRED)
    else:
        chosen = P.keep_props("properties", [p for p in listed if p not in REQUIRED])
    return kept.select(
        "event", user.alias("distinct_id"), time.alias("time"), chosen.alias("properties")
    )


def project_profiles(
    profiles: DataFrame, selectors=None, output_properties: Iterable[str] | None = None
) -> DataFrame:
    """Profiles matching any selector, with all or the listed properties."""
    kept = profiles.where(Q.any_of(selectors))
    if output_properties is None:
        return kept
    return kept.withColumn("properties", P.keep_props("properties", output_properties))
