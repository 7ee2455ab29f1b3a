"""Behavioural filters: how often a user did something in a trailing window."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..functions import predicates as Q

_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 7 * 86400}


def window_seconds(window: str) -> int:
    """``90d``, ``12h``, ``2w`` and so on to seconds."""
    match = re.fullmatch(r"(\d+)([smhdw])", window.strip())
    if not match:
        raise ValueError(f"not a window: {window!r}")
    return int(match[1]) * _SECONDS[match[2]]


def behavior_counts(
    events: DataFrame,
    behaviors: Iterable[Mapping[str, Any]],
    as_of: int,
    offset_hours: float | None = None,
) -> DataFrame:
    """One row per user, one count column per behaviour, users without a match left out.

    A behaviour is ``{"window": "90d", "name": ..., "event_selectors": [...]}``. A
    window is open at its start and closed at ``as_of`` (epoch seconds) plus the
    project's offset, which must be given. All behaviours are counted in one
    aggregation; the scan is limited to the longest window.
    """
    if offset_hours is None:
        raise RuntimeError("behaviors need the project's offset_hours")
    behaviors = list(behaviors)
    end = int(as_of + offset_hours * 3600)
    longest = max(window_seconds(b["window"]) for b in behaviors)
    recent = events.where((F.col("time") > end - longest) & (F.col("time") <= end))
    counts = [
        F.count(
            F.when(
                (F.col("time") > end - window_seconds(b["window"]))
                & Q.event_is(b.get("event_selectors")),
                F.lit(1),
            )
        ).alias(b["name"])
        for b in behaviors
    ]
    return recent.groupBy("distinct_id").agg(*counts)


def with_behaviors(
    profiles: DataFrame,
    events: DataFrame,
    behaviors: Iterable[Mapping[str, Any]],
    as_of: int,
    offset_hours: float | None = None,
) -> DataFrame:
    """Profiles with the behaviour counts as columns, 0 when there are none."""
    behaviors = list(behaviors)
    counts = behavior_counts(events, behaviors, as_of, offset_hours)
    joined = profiles.join(counts, "distinct_id", "left")
    names = [b["name"] for b in behaviors]
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("bigint") for n in names})
