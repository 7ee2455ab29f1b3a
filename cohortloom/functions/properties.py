"""Expressions over open-ended properties.

Properties are ``MAP<STRING,STRING>`` whose values are canonical JSON text: a
string keeps its quotes, a number does not, an explicit null is the text
``null``. Equal values therefore have equal text, so they group, join and
de-duplicate, and ``1`` and ``"1"`` stay apart. All of it is built-in Spark
expressions; nothing here leaves the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

PROPS = "map<string,string>"

_FRACTION = r"^-?[0-9]+[.eE]"
_NUMBER = r"^-?[0-9]"
# What a JSON string must escape.
_ESCAPED = r"[\"\\\x00-\x1f]"
# Whole doubles below this print as integers.
_EXACT = 1e15


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_props() -> Column:
    return F.create_map().cast(PROPS)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it.

    Inside lambda functions Spark does not share common subexpressions.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


# ---------------------------------------------------------------- JSON text


def canonical(text: Column) -> Column:
    """One spelling per JSON scalar: ``1.0`` and ``1`` give the same text.

    Integers, strings and nested values are canonical as the parser prints them;
    only numbers with a fraction or an exponent need a look.
    """
    as_double = text.try_cast("double")
    whole = (as_double == F.floor(as_double)) & (F.abs(as_double) < F.lit(_EXACT))
    number = F.when(whole, as_double.cast("bigint").cast("string")).otherwise(
        F.to_json(as_double.cast("variant"))
    )
    return F.when(text.rlike(_FRACTION), F.coalesce(number, text)).otherwise(text)


def quoted(text: Column) -> Column:
    """JSON string of a text; the writer is asked only if something needs escaping."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(_ESCAPED), F.to_json(text.cast("variant"))).otherwise(plain)


def json_text(c: Column | str, dtype: T.DataType | str) -> Column:
    """Canonical JSON text of a typed column; SQL NULL stays NULL (absent)."""
    c = _col(c)
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    if name in ("tinyint", "smallint", "int", "bigint", "boolean"):
        return c.cast("string")
    if name in ("float", "double") or name.startswith("decimal"):
        d = c.cast("double")
        whole = (d == F.floor(d)) & (F.abs(d) < F.lit(_EXACT))
        return F.when(whole, d.cast("bigint").cast("string")).otherwise(
            F.to_json(d.cast("variant"))
        )
    if name == "string":
        return quoted(c)
    if name == "variant":
        return canonical(F.to_json(c))
    if name in ("date", "timestamp", "timestamp_ntz"):
        printed = F.translate(F.substring(c.cast("string"), 1, 19), " ", "T")
        return F.concat(F.lit('"'), printed, F.lit('"'))
    # Nested values go through the parser so inner keys and numbers are canonical.
    return F.to_json(F.parse_json(F.to_json(c)))


def literal_text(value: Any) -> str:
    """Canonical JSON text of a Python constant."""
    if isinstance(value, float) and value.is_integer() and abs(value) < _EXACT:
        value = int(value)
    return json.dumps(value, separators=(",", ":"), sort_keys=True, ensure_ascii=False)


def value_text(value: Any) -> Column:
    """A property value: a Column is taken as JSON text, anything else as a constant."""
    return value if isinstance(value, Column) else F.lit(literal_text(value))


def props_of(values: Mapping[str, Any]) -> Column:
    """A property map from ``{name: constant or JSON-text Column}``."""
    if not values:
        return empty_props()
    parts: list[Column] = []
    for name, value in values.items():
        parts += [F.lit(name), value_text(value)]
    return F.create_map(*parts)


def props_from_texts(texts: Mapping[str, Column]) -> Column:
    """A property map from ``{name: JSON-text Column}``; NULLs are left out."""
    entries = [
        F.struct(F.lit(name).alias("key"), text.alias("value")) for name, text in texts.items()
    ]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def props_from_columns(columns: Mapping[str, tuple[Column | str, str]]) -> Column:
    """A property map from ``{name: (column, type)}``; NULL columns are left out."""
    return props_from_texts({n: json_text(c, dtype) for n, (c, dtype) in columns.items()})


def props_from_variants(m: Column | str) -> Column:
    """``MAP<STRING,VARIANT>`` to a property map."""
    texts = F.transform_values(_col(m), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    return F.transform_values(texts, lambda _, t: canonical(t))


def parse_props(json_object: Column | str) -> Column:
    """JSON object text to a property map; NULL when it is not an object."""
    return props_from_variants(F.from_json(_col(json_object), "map<string,variant>"))


def props_to_json(m: Column | str) -> Column:
    """A property map back to one JSON object text, keys in order."""
    entries = F.array_sort(F.map_entries(_col(m)))
    pairs = F.transform(
        entries,
        lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def explode_props(
    df: DataFrame, *columns: Column | str, key: str = "name", value: str = "text"
) -> DataFrame:
    """One row per property: ``columns``, ``key`` and ``value`` (JSON text).

    The outer form is used because for the plain one Catalyst infers a filter on
    the map's size and pushes it down, which computes the map twice, and the
    second time without sharing anything within it.
    """
    rows = df.select(*columns, F.explode_outer("properties").alias(key, value))
    return rows.where(F.col(key).isNotNull())


# ------------------------------------------------------------- typed access


def prop(m: Column | str, name: str) -> Column:
    """JSON text of one property, NULL when absent."""
    return F.try_element_at(_col(m), F.lit(name))


def unquoted(text: Column | str) -> Column:
    """Plain text of a JSON value: strings lose quotes and escapes, JSON null is NULL."""
    text = _col(text)
    simple = text.startswith('"') & ~F.contains(text, F.lit("\\"))
    parsed = F.try_variant_get(F.try_parse_json(text), "$", "string")
    return (
        F.when(text == "null", F.lit(None).cast("string"))
        .when(simple, F.substring(text, F.lit(2), F.length(text) - 2))
        .when(text.startswith('"'), parsed)
        .otherwise(text)
    )


def prop_string(m: Column | str, name: str) -> Column:
    return unquoted(prop(m, name))


def prop_number(m: Column | str, name: str) -> Column:
    return prop(m, name).try_cast("double")


def prop_bigint(m: Column | str, name: str) -> Column:
    return prop(m, name).try_cast("bigint")


def prop_boolean(m: Column | str, name: str) -> Column:
    return prop(m, name).try_cast("boolean")


def prop_timestamp(m: Column | str, name: str) -> Column:
    return prop_string(m, name).try_cast("timestamp_ntz")


# ---------------------------------------------------------------- overlays


def overlay(base: Column | str, top: Column | str) -> Column:
    """Both maps as one; where they share a key ``top`` wins. NULL counts as empty."""
    base = F.coalesce(_col(base), empty_props())

    def onto(t: Column) -> Column:
        return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(t, k)), t)

    # Bound, as the filter would otherwise compute ``top`` once per key of ``base``.
    return bind(F.coalesce(_col(top), empty_props()), onto)


def overlay_all(*maps: Column | str) -> Column:
    """Several maps as one; the rightmost wins."""
    out = _col(maps[0])
    for m in maps[1:]:
        out = overlay(out, m)
    return out


def keep_props(m: Column | str, names: Iterable[str]) -> Column:
    names = list(names)
    return F.map_filter(_col(m), lambda k, _: k.isin(names))


def drop_props(m: Column | str, names: Iterable[str] | Column) -> Column:
    if isinstance(names, Column):
        return F.map_filter(_col(m), lambda k, _: ~F.array_contains(names, k))
    names = list(names)
    return F.map_filter(_col(m), lambda k, _: ~k.isin(names))


def rename_props(m: Column | str, names: Mapping[str, str]) -> Column:
    """Keep and rename the keys listed in ``names``; other keys are dropped.

    Where two source keys share a target, the one spelled like the target wins,
    then the one listed first.
    """
    m = _col(m)
    sources: dict[str, list[str]] = {}
    for src, dst in names.items():
        sources.setdefault(dst, []).append(src)
    collisions = [
        (src, ranked[:i])
        for dst, srcs in sources.items()
        for ranked in [sorted(srcs, key=lambda s: (s != dst, srcs.index(s)))]
        for i, src in enumerate(ranked)
        if i
    ]

    def kept(k: Column, _: Column) -> Column:
        ok = k.isin(list(names))
        for src, better in collisions:
            hidden = F.lit(False)
            for b in better:
                hidden = hidden | F.map_contains_key(m, F.lit(b))
            ok = ok & ~((k == src) & hidden)
        return ok

    chosen = F.map_filter(m, kept)
    changed = [F.lit(x) for pair in names.items() if pair[0] != pair[1] for x in pair]
    if not changed:
        return chosen
    table = F.create_map(*changed)
    return F.transform_keys(chosen, lambda k, _: F.coalesce(F.try_element_at(table, k), k))


# ------------------------------------------------------------------- lists


def is_list(text: Column) -> Column:
    return text.startswith("[")


def open_list(text: Column | str) -> Column:
    """JSON list text to an array of canonical element texts; NULL if not a list."""
    text = _col(text)
    items = F.from_json(F.when(is_list(text), text), "array<variant>")
    texts = F.transform(items, lambda v: F.coalesce(F.to_json(v), F.lit("null")))
    return F.transform(texts, canonical)


def close_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


# ----------------------------------------------- the update operations on a map


def set_props(m: Column, value: Column) -> Column:
    return overlay(m, value)


def set_once_props(m: Column, value: Column) -> Column:
    return overlay(value, m)


def add_props(m: Column, value: Column) -> Column:
    """Add numbers to numeric properties.

    An absent property counts as 0; a property that holds something else than
    a number, or an amount that is not a number, leaves it unchanged.
    """
    m = F.coalesce(m, empty_props())

    def one(k: Column, v: Column) -> Column:
        old = F.try_element_at(m, k)
        total = F.coalesce(old.try_cast("double"), F.lit(0.0)) + v.try_cast("double")
        fits = (old.isNull() | old.rlike(_NUMBER)) & v.rlike(_NUMBER)
        return F.when(fits, bind(total, lambda t: json_text(t, "double"))).otherwise(old)

    changed = F.map_filter(F.transform_values(value, one), lambda _, v: v.isNotNull())
    return overlay(m, changed)


def append_props(m: Column, value: Column) -> Column:
    """Append one element per property; an absent property becomes a new list.

    The element is spliced into the list text, so nothing is parsed.
    A property that is not a list is left unchanged.
    """
    m = F.coalesce(m, empty_props())

    def one(k: Column, v: Column) -> Column:
        old = F.try_element_at(m, k)
        fresh = F.concat(F.lit("["), v, F.lit("]"))
        body = F.substring(old, F.lit(1), F.length(old) - 1)
        return (
            F.when(old.isNull() | (old == "[]"), fresh)
            .when(is_list(old), F.concat(body, F.lit(","), v, F.lit("]")))
            .otherwise(old)
        )

    return overlay(m, F.transform_values(value, one))


def remove_props(m: Column, value: Column) -> Column:
    """Remove every copy of one element per property; absent or not a list = unchanged."""
    return F.transform_values(
        F.coalesce(m, empty_props()),
        lambda k, old: F.when(
            is_list(old) & F.map_contains_key(value, k),
            close_list(F.filter(open_list(old), lambda e: e != value[k])),
        ).otherwise(old),
    )


def union_props(m: Column, value: Column) -> Column:
    """Add list elements not there yet, keeping order; copies already there stay."""
    m = F.coalesce(m, empty_props())

    def one(k: Column, v: Column) -> Column:
        old = F.try_element_at(m, k)
        mine = F.coalesce(open_list(old), F.array().cast("array<string>"))
        merged = bind(
            mine, lambda a: close_list(F.concat(a, F.array_except(open_list(v), a)))
        )
        return F.when((old.isNull() | is_list(old)) & is_list(v), merged).otherwise(old)

    changed = F.map_filter(F.transform_values(value, one), lambda _, v: v.isNotNull())
    return overlay(m, changed)


def rename_prop(m: Column | str, old: str, new: str, unset: bool = True) -> Column:
    """Copy ``old`` to ``new`` and, unless told not to, drop ``old``; absent = unchanged."""
    m = _col(m)
    copied = overlay(m, F.create_map(F.lit(new), prop(m, old)))
    result = drop_props(copied, [old]) if unset and old != new else copied
    return F.when(F.map_contains_key(m, F.lit(old)), result).otherwise(m)
