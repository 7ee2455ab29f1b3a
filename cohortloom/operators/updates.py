"""Profile updates: profiles table in, profiles table out.

A profiles table has its key columns (``distinct_id`` for users, ``group_key``
and ``group_id`` for groups) and ``properties``. One update runs as a single
projection when it targets a predicate, and as one join on the key when it
targets a table of ids. No row is touched by Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import predicates as Q
from ..functions import properties as P

USER_KEYS = ("distinct_id",)
GROUP_KEYS = ("group_key", "group_id")

# Operation names of update records.
SET, SET_ONCE, UNSET, ADD = "$set", "$set_once", "$unset", "$add"
APPEND, REMOVE, UNION, DELETE = "$append", "$remove", "$union", "$delete"
OPERATIONS = (SET, SET_ONCE, UNSET, ADD, APPEND, REMOVE, UNION, DELETE)
# Operations that make a profile for an id not seen before.
CREATING = (SET, SET_ONCE, ADD, APPEND, UNION)

_ON_MAP: dict[str, Callable[[Column, Column], Column]] = {
    SET: P.set_props,
    SET_ONCE: P.set_once_props,
    ADD: P.add_props,
    APPEND: P.append_props,
    REMOVE: P.remove_props,
    UNION: P.union_props,
}

Value = Column | Mapping[str, Any] | Iterable[str] | Callable[[DataFrame], Column] | None
Targets = Column | DataFrame | None


def _checked(operation: str) -> str:
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation}; one of {', '.join(OPERATIONS)}")
    return operation


def _value_column(operation: str, value: Value, profiles: DataFrame) -> Column | None:
    """The update value as a property map (a list of names for ``$unset``)."""
    if operation == DELETE:
        return None
    if callable(value) and not isinstance(value, Column):
        value = value(profiles)
    if isinstance(value, Column):
        return value
    if operation == UNSET:
        names = [value] if isinstance(value, str) else list(value or [])
        return F.array(*[F.lit(n) for n in names]).cast("array<string>")
    if not isinstance(value, Mapping):
        raise TypeError(f"{operation} needs a mapping or a Column, got {type(value).__name__}")
    return P.props_of(value)


def changed_props(operation: str, m: Column, value: Column) -> Column:
    """One operation as an expression on a property map."""
    if operation == UNSET:
        return P.drop_props(m, value)
    return _ON_MAP[operation](m, value)


def update(
    profiles: DataFrame,
    operation: str,
    value: Value = None,
    targets: Targets = None,
    keys: Iterable[str] = USER_KEYS,
    matched: Observation | None = None,
) -> DataFrame:
    """Apply one operation.

    ``value`` is a constant mapping (constants or JSON-text Columns), a property
    map Column over ``profiles``, a function of the profiles DataFrame giving
    one, or names for ``$unset``. ``targets`` is ``None`` (everyone), a
    predicate over ``profiles``, or a DataFrame of keys. Keys without a stored
    profile get one when the operation can create it. ``matched`` receives the
    counts ``matched`` (targeted rows) and ``applied`` (rows that changed).
    """
    operation, keys = _checked(operation), list(keys)
    payload = _value_column(operation, value, profiles)

    if isinstance(targets, DataFrame):
        ids = targets.select(*keys).dropna().dropDuplicates(keys).withColumn("_hit", F.lit(True))
        creates = operation in CREATING
        stored = profiles.withColumn("_stored", F.lit(True))
        flagged = stored.join(ids, keys, "full" if creates else "left")
        hit = F.col("_hit").isNotNull()
        before = F.when(F.col("_stored"), F.col("properties")).otherwise(P.empty_props())
    else:
        flagged = profiles.withColumn("_stored", F.lit(True))
        hit = F.lit(True) if targets is None else F.coalesce(targets, F.lit(False))
        before = F.col("properties")

    if operation == DELETE:
        flagged = flagged.withColumn("_applied", hit)
    else:
        after = F.when(hit, changed_props(operation, before, payload)).otherwise(before)
        # Decided before the map is replaced: the predicate may read the old map.
        flagged = flagged.withColumns({"_applied": hit, "_after": after})
    if matched is not None:
        flagged = flagged.observe(
            matched,
            F.coalesce(F.sum(F.col("_applied").cast("bigint")), F.lit(0)).alias("matched"),
            F.coalesce(
                F.sum(
                    (
                        F.col("_applied")
                        & (
                            F.lit(True)
                            if operation == DELETE
                            else ~same_props(F.col("_after"), before)
                            | F.col("_stored").isNull()
                        )
                    ).cast("bigint")
                ),
                F.lit(0),
            ).alias("applied"),
        )
    if operation == DELETE:
        return flagged.where(~F.col("_applied")).select(*profiles.columns)
    result = flagged.withColumn("properties", F.col("_after"))
    return result.select(*profiles.columns)


def same_props(a: Column, b: Column) -> Column:
    """Whether two property maps hold the same entries."""
    return F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))


def set_properties(profiles, value, targets=None, **kw) -> DataFrame:
    """Overwrite properties."""
    return update(profiles, SET, value, targets, **kw)


def set_once(profiles, value, targets=None, **kw) -> DataFrame:
    """Write only properties that are not there yet."""
    return update(profiles, SET_ONCE, value, targets, **kw)


def unset(profiles, names, targets=None, **kw) -> DataFrame:
    """Drop properties."""
    return update(profiles, UNSET, names, targets, **kw)


def add(profiles, value, targets=None, **kw) -> DataFrame:
    """Add to numeric properties."""
    return update(profiles, ADD, value, targets, **kw)


def append(profiles, value, targets=None, **kw) -> DataFrame:
    """Append one element to list properties."""
    return update(profiles, APPEND, value, targets, **kw)


def remove(profiles, value, targets=None, **kw) -> DataFrame:
    """Remove one element from list properties."""
    return update(profiles, REMOVE, value, targets, **kw)


def union(profiles, value, targets=None, **kw) -> DataFrame:
    """Add the elements of a list that list properties lack."""
    return update(profiles, UNION, value, targets, **kw)


def delete(profiles, targets=None, **kw) -> DataFrame:
    """Drop profiles."""
    return update(profiles, DELETE, None, targets, **kw)


def rename_property(
    profiles: DataFrame, old: str, new: str, targets: Targets = None, unset: bool = True
) -> DataFrame:
    """Rename a property where it is defined; other profiles stay as they are."""
    renamed = P.rename_prop("properties", old, new, unset)
    if isinstance(targets, DataFrame):
        ids = targets.select("distinct_id").dropna().dropDuplicates().withColumn("_hit", F.lit(True))
        flagged = profiles.join(ids, "distinct_id", "left")
        renamed = F.when(F.col("_hit"), renamed).otherwise(F.col("properties"))
        return flagged.withColumn("properties", renamed).select(*profiles.columns)
    hit = Q.defined("properties", old) if targets is None else targets
    return profiles.withColumn(
        "properties", F.when(hit, renamed).otherwise(F.col("properties"))
    )


def targets_of(
    profiles: DataFrame, targets: Targets = None, keys: Iterable[str] = USER_KEYS
) -> DataFrame:
    """The stored profiles an update would touch (for a backup before it runs)."""
    if targets is None:
        return profiles
    if isinstance(targets, DataFrame):
        keys = list(keys)
        return profiles.join(targets.select(*keys), keys, "left_semi")
    return profiles.where(targets)


def update_from_rows(
    profiles: DataFrame,
    rows: DataFrame,
    operation: str = SET,
    value: Column | str = "value",
    keys: Iterable[str] = USER_KEYS,
    create: bool = True,
) -> DataFrame:
    """Let a query's rows drive an update: one row per key, value taken from the row.

    Rows are keyed by ``distinct_id`` and carry a property map (names for
    ``$unset``). With ``create`` off, keys without a profile are passed over.
    Several rows per key belong in :func:`..folding.apply_updates`, which
    orders them.
    """
    operation, keys = _checked(operation), list(keys)
    if operation == DELETE:
        return delete(profiles, rows, keys=keys)
    value = P._col(value)
    source = rows.select(*keys, value.alias("_value"))
    how = "full" if create and operation in CREATING else "left"
    joined = profiles.join(source, keys, how)
    before = F.coalesce(F.col("properties"), P.empty_props())
    after = F.when(
        F.col("_value").isNotNull(), changed_props(operation, before, F.col("_value"))
    ).otherwise(before)
    return joined.withColumn("properties", after).select(*profiles.columns)


def latest_properties(rows: DataFrame, order: Column | str) -> DataFrame:
    """Many property maps per id to one: per property the last value in ``order`` wins.

    One value per id and property is kept while aggregating. ``order`` must be
    unique per id.
    """
    known = rows.where(F.col("distinct_id").isNotNull())
    return (
        P.explode_props(known, "distinct_id", P._col(order).alias("_o"))
        .groupBy("distinct_id", "name")
        .agg(F.max_by("text", F.struct("_o", "text")).alias("text"))
        .groupBy("distinct_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("properties"))
    )


# ----------------------------------------------------------------- update records


def with_profile_id(df: DataFrame, out: str = "distinct_id") -> DataFrame:
    """``$distinct_id``, else ``distinct_id``; rows with neither are dropped."""
    names = [c for c in ("$distinct_id", "distinct_id") if c in df.columns]
    if not names:
        raise ValueError("rows need a $distinct_id or distinct_id column")
    found = F.coalesce(*[F.col(f"`{c}`") for c in names])
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(found.alias(out), *rest).where(F.col(out).isNotNull())


def update_records(
    rows: DataFrame,
    token: str,
    operation: str,
    value: Column | str = "value",
    ignore_alias: bool = False,
) -> DataFrame:
    """Update records as JSON text, one per row of ``rows`` that has an id.

    ``value`` is JSON text, or a property map that becomes a JSON object.
    """
    identified = with_profile_id(rows)
    return identified.select(
        "distinct_id",
        _envelope(
            identified,
            {
                "$ignore_time": F.lit("true"),
                "$ip": F.lit("0"),
                "$ignore_alias": F.lit(P.literal_text(ignore_alias)),
                "$token": F.lit(P.literal_text(token)),
                _checked(operation): _as_json(identified, value),
                "$distinct_id": P.json_text("distinct_id", "string"),
            },
        ).alias("record"),
    )


def group_update_records(
    rows: DataFrame,
    token: str,
    group_key: str,
    operation: str,
    value: Column | str = "value",
) -> DataFrame:
    """As :func:`update_records` for group profiles: the id goes to ``$group_id``."""
    identified = with_profile_id(rows, "group_id")
    return identified.select(
        "group_id",
        _envelope(
            identified,
            {
                "$ignore_time": F.lit("true"),
                "$ip": F.lit("0"),
                "$token": F.lit(P.literal_text(token)),
                "$group_key": F.lit(P.literal_text(group_key)),
                _checked(operation): _as_json(identified, value),
                "$group_id": P.json_text("group_id", "string"),
            },
        ).alias("record"),
    )


def _as_json(df: DataFrame, value: Column | str) -> Column:
    value = P._col(value)
    kind = df.select(value).schema[0].dataType.typeName()
    return P.props_to_json(value) if kind == "map" else value


def _envelope(df: DataFrame, fields: Mapping[str, Column]) -> Column:
    pairs = [F.concat(F.lit(P.literal_text(k) + ":"), v) for k, v in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def read_update_records(records: DataFrame, column: str = "record", order: str | None = None) -> DataFrame:
    """Raw update records (JSON text) to ``distinct_id, seq, op, payload`` rows.

    A record may carry several operations: they are applied in the order of
    ``OPERATIONS``, all before those of the next position. ``$unset`` takes a
    list of names, ``$delete`` has no payload.
    """
    seq = (F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")) * len(OPERATIONS)
    rank = F.array_position(F.array(*[F.lit(op) for op in OPERATIONS]), F.col("op")) - 1
    fields = F.from_json(column, "map<string,variant>")
    parsed = records.select(seq.alias("seq"), fields.alias("_f"))
    ops = F.filter(F.map_keys("_f"), lambda k: k.isin(*OPERATIONS))
    given = F.try_element_at("_f", F.col("op"))

    def text(name: str) -> Column:
        return F.try_variant_get(F.try_element_at("_f", F.lit(name)), "$", "string")

    names = F.array_distinct(F.try_variant_get(given, "$", "array<string>"))
    dropped = F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.lit("null"))))
    payload = P.props_from_variants(F.try_variant_get(given, "$", "map<string,variant>"))
    return (
        parsed.withColumn("op", F.explode_outer(ops))
        .where(F.col("op").isNotNull())
        .select(
            F.coalesce(text("$distinct_id"), text("distinct_id")).alias("distinct_id"),
            (F.col("seq") + rank).alias("seq"),
            "op",
            F.when(F.col("op") == UNSET, dropped)
            .when(F.col("op") != DELETE, payload)
            .alias("payload"),
        )
        .where(F.col("distinct_id").isNotNull())
    )
