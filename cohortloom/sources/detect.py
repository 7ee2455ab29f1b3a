"""What a file holds: a JSON array, JSON lines, or CSV of events or profiles."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import file_tasks, list_files, open_file

# Names of the formats.
JSON_ARRAY, JSON_LINES = "json_array", "json_lines"
CSV_EVENTS, CSV_PROFILES, UNKNOWN, EMPTY = "csv_events", "csv_profiles", "unknown", "empty"


def _first_line(text: io.TextIOBase) -> str | None:
    """The first line that is not blank; of JSON only its first character.

    A JSON array is often a single line, as long as the file.
    """
    while (first := text.read(1)).isspace():
        pass
    return first if first in ("[", "{") else ((first + text.readline()).strip() or None)


def _first_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        heads = []
        for path in frame["path"]:
            with open_file(path) as raw:
                stream = gzip.open(raw) if path.endswith(".gz") else raw
                text = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace")
                heads.append(_first_line(text))
        yield pd.DataFrame({"path": frame["path"], "first_line": heads})


def first_lines(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``path, first_line``: each file's first line that is not blank, or ``[`` or ``{``.

    Only that much of a file is read, whatever its size. Files are dealt over
    a stated number of tasks: paths are short, and adaptive execution would join
    partitions of them into one task.
    """
    listed = list_files(spark, path, glob).select("path")
    return listed.repartition(file_tasks(spark), "path").mapInPandas(_first_lines, "path string, first_line string")


def classify(line: Column) -> Column:
    """Format from the first line. A quoted header is CSV like any other."""
    cells = F.transform(F.split(line, ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    header = F.transform(cells, F.trim)
    return (
        F.when(line.isNull(), EMPTY)
        .when(line.startswith("["), JSON_ARRAY)
        .when(line.startswith("{"), JSON_LINES)
        .when(F.array_contains(header, "event"), CSV_EVENTS)
        .when(F.array_contains(header, "$distinct_id"), CSV_PROFILES)
        .otherwise(UNKNOWN)
    )


def detect_formats(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``path, format`` of every file under ``path`` that is not of zero length."""
    found = first_lines(spark, path, glob)
    return found.select("path", classify(F.col("first_line")).alias("format"))
