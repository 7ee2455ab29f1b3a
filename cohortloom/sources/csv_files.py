"""CSV sources with type recovery per cell."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import properties as P
from .splits import csv_headers, csv_rows


_SCALAR = (
    r"^[ \t\r\n]*(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null)[ \t\r\n]*$"
)
_OPENING = r'^[ \t\r\n]*["\[{]'


def is_json(cell: Column) -> Column:
    """The whole text is one JSON value.

    Spark's parser stops after the first value and ignores the rest, so
    ``12 monkeys`` would pass for 12. Text put between brackets must be a list
    of one, and put between braces a member: what follows the first value
    cannot close both.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), cell, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), cell, F.lit("}")))
    alone = F.size(F.try_variant_get(in_list, "$", "array<variant>")) == 1
    return F.when(cell.rlike(_SCALAR), F.lit(True)).otherwise(
        cell.rlike(_OPENING) & F.coalesce(alone & in_object.isNotNull(), F.lit(False))
    )


def cell_text(cell: Column | str) -> Column:
    """JSON text of a CSV cell: the JSON value if it parses, else a string.

    Empty is NULL (absent). ``NaN`` and ``Infinity`` are not JSON and stay strings.
    """
    cell = P._col(cell)
    parsed = F.when(is_json(cell), P.canonical(F.to_json(F.try_parse_json(cell))))
    return F.when(cell != "", F.coalesce(parsed, P.quoted(cell)))


def props_from_cells(df: DataFrame, ignored: Iterable[str]) -> Column:
    """All cells but the ignored columns as one property map; empty cells are absent."""
    ignored = set(ignored)
    texts = {c: cell_text(F.col(f"`{c}`")) for c in df.columns if c not in ignored}
    return P.props_from_texts(texts) if texts else P.empty_props()


def read_cells(spark: SparkSession, paths) -> DataFrame:
    """CSV with a header and a row on each line, every cell text; quotes doubled.

    A short row's missing cells are empty. Files must agree on their header.
    Spark splits such files itself.
    """
    return spark.read.options(
        header=True,
        escape='"',
        quote='"',
        inferSchema=False,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        mode="PERMISSIVE",
        enforceSchema=False,
    ).csv(paths)


def _needs(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"CSV header lacks {', '.join(missing)}")


def events_from_cells(
    df: DataFrame, time_converter: Callable[[Column], Column] | None = None
) -> DataFrame:
    """CSV rows to shaped events; ``time`` must be an integer unless converted."""
    _needs(df, ("event", "distinct_id", "time"))
    time = time_converter(F.col("time")) if time_converter else F.col("time")
    return df.select(
        "event",
        "distinct_id",
        time.cast("bigint").alias("time"),
        props_from_cells(df, ("event", "distinct_id", "time")).alias("properties"),
    )


def profiles_from_cells(df: DataFrame) -> DataFrame:
    """CSV rows to profiles; the id stays text."""
    _needs(df, ("$distinct_id",))
    return df.select(
        F.col("`$distinct_id`").alias("distinct_id"),
        props_from_cells(df, ("$distinct_id",)).alias("properties"),
    )


def _rows_with(spark: SparkSession, paths, names: Iterable[str]) -> DataFrame:
    """Rows of CSV files as maps; each file's header must have ``names``."""
    headers = csv_headers(spark, paths)
    lacking = F.array_except(F.array(*map(F.lit, names)), "header")
    bad = headers.where(F.size("header") > 0).select("path", lacking.alias("lacks")).where(F.size("lacks") > 0).first()
    if bad:
        raise ValueError(f"CSV header lacks {', '.join(bad['lacks'])}: {bad['path']}")
    return csv_rows(spark, paths)


def _props_of_rows(ignored: Iterable[str]) -> Column:
    kept = F.map_filter("cells", lambda name, _: ~name.isin(*ignored))
    return F.transform_values(kept, lambda _, cell: cell_text(cell))


def read_events(
    spark: SparkSession, paths, time_converter=None, multi_line: bool = True
) -> DataFrame:
    """Shaped events from CSV files, of which each has a header of its own.

    Cells may hold newlines; files are split over tasks all the same. Where no
    cell does and all headers agree, ``multi_line`` off leaves parsing to Spark.
    """
    if not multi_line:
        return events_from_cells(read_cells(spark, paths), time_converter)
    fixed = ("event", "distinct_id", "time")
    rows = _rows_with(spark, paths, fixed)
    named = rows.select(*[F.try_element_at("cells", F.lit(n)).alias(n) for n in fixed], _props_of_rows(fixed).alias("properties"))
    time = time_converter(F.col("time")) if time_converter else F.col("time")
    return named.select("event", "distinct_id", time.cast("bigint").alias("time"), "properties")


def read_profiles(spark: SparkSession, paths, multi_line: bool = True) -> DataFrame:
    """Profiles from CSV files; as :func:`read_events`."""
    if not multi_line:
        return profiles_from_cells(read_cells(spark, paths))
    fixed = ("$distinct_id",)
    return _rows_with(spark, paths, fixed).select(
        F.try_element_at("cells", F.lit("$distinct_id")).alias("distinct_id"), _props_of_rows(fixed).alias("properties")
    )


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Groups from a folder of CSV files with a folder ``group_type=...`` per type."""
    fixed = ("$distinct_id",)
    rows = _rows_with(spark, path, fixed)
    kind = F.url_decode(F.replace(F.regexp_extract("path", "/group_type=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    return rows.select(
        kind.alias("group_type"),
        F.try_element_at("cells", F.lit("$distinct_id")).alias("group_id"),
        _props_of_rows(fixed).alias("properties"),
    )
