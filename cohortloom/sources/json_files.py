"""JSON sources: one object per line, or one array per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import properties as P
from .splits import json_items

EVENT_JSON = "event string, properties map<string,variant>"
PROFILE_JSON = "`$distinct_id` string, distinct_id string, `$properties` map<string,variant>"
_BAD = "_corrupt_record"


def _read(spark: SparkSession, paths, schema: str, whole_file: bool, fail_fast: bool) -> DataFrame:
    if whole_file:
        return _read_items(spark, paths, schema, fail_fast)
    if fail_fast:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    return spark.read.schema(f"{schema}, {_BAD} string").option("columnNameOfCorruptRecord", _BAD).json(paths)


def _read_items(spark: SparkSession, paths, schema: str, fail_fast: bool) -> DataFrame:
    """Items of JSON arrays, parsed one by one; an item its file cuts off is a bad one."""
    items = json_items(spark, paths)
    if fail_fast:
        cut_off = F.raise_error(F.concat(F.lit("JSON array without an end: "), F.substring("record", 1, 200)))
        record = F.when(F.col("whole"), F.col("record")).otherwise(cut_off)
        return items.select(F.from_json(record, schema, {"mode": "FAILFAST"}).alias("_i")).select("_i.*")
    options = {"columnNameOfCorruptRecord": _BAD}
    parsed = items.select("*", F.from_json("record", f"{schema}, {_BAD} string", options).alias("_i"))
    good = F.when(F.col("whole"), F.col("_i"))
    names = [n for n in parsed.schema["_i"].dataType.names if n != _BAD]
    bad = F.when(F.col("whole"), F.col(f"_i.{_BAD}")).otherwise(F.col("record"))
    return parsed.select(*[good[n].alias(n) for n in names], bad.alias(_BAD))


def read_events(
    spark: SparkSession, paths, whole_file: bool = False, fail_fast: bool = True
) -> DataFrame:
    """Raw events (``event, properties``) from JSON files, plain or gzipped.

    A bad line stops the read; with ``fail_fast`` off it is kept in
    ``_corrupt_record`` instead. ``whole_file`` reads files that hold one JSON
    array or one object; arrays are split over tasks, whatever their lines.
    """
    df = _read(spark, paths, EVENT_JSON, whole_file, fail_fast)
    extra = [] if fail_fast else [_BAD]
    return df.select("event", P.props_from_variants("properties").alias("properties"), *extra)


def read_profiles(
    spark: SparkSession, paths, whole_file: bool = False, fail_fast: bool = True
) -> DataFrame:
    """Profiles (``distinct_id, properties``) from JSON files; either id spelling."""
    df = _read(spark, paths, PROFILE_JSON, whole_file, fail_fast)
    extra = [] if fail_fast else [_BAD]
    return df.select(
        F.coalesce("`$distinct_id`", "distinct_id").alias("distinct_id"),
        P.props_from_variants("`$properties`").alias("properties"),
        *extra,
    )


def read_records(spark: SparkSession, paths) -> DataFrame:
    """Lines of JSON objects as text in ``record`` (update records, raw exports)."""
    return spark.read.text(paths).where(F.trim("value") != "").select(F.col("value").alias("record"))
