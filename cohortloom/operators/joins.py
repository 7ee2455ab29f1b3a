"""Joins of a large side to a side with one row per key."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# A key with more rows than this is spread over several tasks. At most
# total_rows / HOT_ROWS keys can qualify, which bounds the list of hot keys:
# 10^12 rows have fewer than 500,000 of them.
HOT_ROWS = 2_000_000

# Shares of the rows without a key.
_NULL_SHARES = 4096


def hot_keys(many: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of shares to cut them into."""
    counted = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return shares_of(counted, keys, hot_rows)


def shares_of(counted: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """As :func:`hot_keys`, from row counts ``n`` that are already known."""
    return counted.where(F.col("n") > hot_rows).select(
        *keys, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("_shares")
    )


def row_hash(df: DataFrame, skip: list[str], salt: list[str] | None = None) -> Column:
    """A hash of the columns named in ``salt``, or of all narrow ones but ``skip``.

    Maps, arrays and structs are left out: hashing them would make a scan read
    and parse what the query may not need.
    """
    wide = (T.MapType, T.ArrayType, T.StructType, T.VariantType, T.BinaryType)
    parts = salt or [
        f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, wide)
    ]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    salt: list[str] | None = None,
) -> DataFrame:
    """Join every row of ``many`` to its at most one row of ``one``.

    A key holding a large part of ``many`` would send all those rows to one
    task. Such keys are found by an exact count, their rows are dealt over
    several shares, and the matching row of ``one`` is repeated once per share.
    Rows of other keys, and the result, are untouched. Rows with a NULL key
    match nothing, so they are dealt over many shares whatever their number.
    ``salt`` names the columns rows are dealt by, the narrow ones by default.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left: {how}")
    if hot is None:
        hot = hot_keys(many, keys, hot_rows)
    # Dealt by content, so a task that runs again deals its rows the same way.
    place = row_hash(many, keys, salt)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    dealt = (
        F.when(no_key, F.pmod(place, F.lit(_NULL_SHARES)))
        .when(F.col("_shares").isNotNull(), F.pmod(place, F.col("_shares").cast("bigint")))
        .otherwise(F.lit(0))
    )
    left = many.join(hot, keys, "left").withColumn("_share", dealt.cast("int")).drop("_shares")
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)
    right = one.join(hot, keys, "left").withColumn("_share", F.explode(repeats)).drop("_shares")
    return left.join(right, [*keys, "_share"], how).drop("_share")


def resolve_alias(
    df: DataFrame,
    aliases: DataFrame,
    ignore_alias: bool = False,
    id_col: str = "distinct_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replace ids by their canonical id.

    ``aliases`` has ``alias`` and ``canonical_id``, one row per alias; ids not
    listed stay. ``ignore_alias`` skips the lookup.
    """
    if ignore_alias:
        return df
    table = aliases.select(
        F.col("alias").alias(id_col), F.col("canonical_id").alias("_canonical")
    )
    joined = lookup_join(df, table, [id_col], "left", hot_rows=hot_rows)
    resolved = F.coalesce(F.col("_canonical"), F.col(id_col)).alias(id_col)
    return joined.select(*[resolved if c == id_col else F.col(c) for c in df.columns])


def join_profiles(
    events: DataFrame, profiles: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Events with the profile of their user; events without a profile drop out."""
    right = profiles.select(
        "distinct_id", F.col("properties").alias("profile_properties")
    )
    salt = [c for c in ("time", "event") if c in events.columns]
    return lookup_join(events, right, ["distinct_id"], "inner", hot_rows=hot_rows, salt=salt)
