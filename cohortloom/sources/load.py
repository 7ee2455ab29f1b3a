"""Loading items from whatever the caller has: a DataFrame, a path or a list."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions import properties as P
from ..operators.events import raw_events
from . import csv_files, detect, json_files


def _paths_by_format(spark: SparkSession, path) -> dict[str, list[str]]:
    # One row per file: the driver's file listing holds the same paths already.
    found: dict[str, list[str]] = {}
    for row in detect.detect_formats(spark, path).orderBy("path").toLocalIterator():
        found.setdefault(row["format"], []).append(row["path"])
    return found


def _union(parts: list[DataFrame], what: str) -> DataFrame:
    if not parts:
        raise ValueError(f"no {what} found")
    return reduce(lambda a, b: a.unionByName(b), parts)


def load_events(spark: SparkSession, data) -> DataFrame:
    """Raw events from a DataFrame, a path, or a list of ``{event, properties}``.

    A path may hold JSON lines, JSON arrays and event CSV side by side.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, (list, tuple)):
        rows = [(e.get("event"), P.literal_text(e.get("properties") or {})) for e in data]
        df = spark.createDataFrame(rows, "event string, properties string")
        return df.withColumn("properties", P.parse_props("properties"))
    if not isinstance(data, str):
        raise TypeError("events must be a DataFrame, a path or a list of dicts")
    found = _paths_by_format(spark, data)
    parts = []
    if paths := found.get(detect.JSON_LINES):
        parts.append(json_files.read_events(spark, paths))
    if paths := found.get(detect.JSON_ARRAY):
        parts.append(json_files.read_events(spark, paths, whole_file=True))
    if paths := found.get(detect.CSV_EVENTS):
        parts.append(raw_events(csv_files.read_events(spark, paths)))
    return _union(parts, "events")


def load_profiles(spark: SparkSession, data) -> DataFrame:
    """Profiles from a DataFrame, a path, or a list of ``{$distinct_id, $properties}``."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, (list, tuple)):
        rows = [
            (
                _text_id(p.get("$distinct_id", p.get("distinct_id"))),
                P.literal_text(p.get("$properties") or {}),
            )
            for p in data
        ]
        df = spark.createDataFrame(rows, "distinct_id string, properties string")
        return df.withColumn("properties", P.parse_props("properties"))
    if not isinstance(data, str):
        raise TypeError("profiles must be a DataFrame, a path or a list of dicts")
    found = _paths_by_format(spark, data)
    parts = []
    if paths := found.get(detect.JSON_LINES):
        parts.append(json_files.read_profiles(spark, paths))
    if paths := found.get(detect.JSON_ARRAY):
        parts.append(json_files.read_profiles(spark, paths, whole_file=True))
    if paths := found.get(detect.CSV_PROFILES):
        parts.append(csv_files.read_profiles(spark, paths))
    return _union(parts, "profiles")


def _text_id(value) -> str | None:
    return value if value is None or isinstance(value, str) else str(value)


def register_views(events: DataFrame, profiles: DataFrame, groups: DataFrame | None = None) -> None:
    """Make the tables available to ``run_query`` as ``events``, ``profiles``, ``groups``."""
    events.createOrReplaceTempView("events")
    profiles.createOrReplaceTempView("profiles")
    if groups is not None:
        groups.createOrReplaceTempView("groups")


def run_query(spark: SparkSession, query: str, params: Mapping | None = None) -> DataFrame:
    """A user's own Spark SQL over the registered views, with named parameters."""
    return spark.sql(query, args=dict(params or {}))


