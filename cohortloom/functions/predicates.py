"""Selectors as Column predicates over a property map."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

from . import properties as P

# JSON texts that count as false (absent counts as false too).
FALSY_TEXTS = ("null", "false", "0", '""')


def defined(m: Column | str, name: str) -> Column:
    """The property exists, even if it is null."""
    return F.map_contains_key(P._col(m), F.lit(name))


def truthy(m: Column | str, name: str) -> Column:
    """Not absent, null, false, 0 or the empty string."""
    return F.coalesce(~P.prop(m, name).isin(*FALSY_TEXTS), F.lit(False))


def equals(m: Column | str, name: str, value: Any) -> Column:
    """Typed equality: the string ``"1"`` does not equal the number ``1``."""
    return P.prop(m, name).eqNullSafe(P.value_text(value))


def contains(m: Column | str, name: str, value: str) -> Column:
    """Element of a list, or substring of a string; anything else is false."""
    text = P.prop(m, name)
    in_list = F.array_contains(P.open_list(text), P.literal_text(value))
    in_text = F.contains(P.unquoted(text), F.lit(value))
    return F.coalesce(
        F.when(P.is_list(text), in_list).when(text.startswith('"'), in_text), F.lit(False)
    )


def greater(m: Column | str, name: str, value: float) -> Column:
    return F.coalesce(P.prop_number(m, name) > value, F.lit(False))


def less(m: Column | str, name: str, value: float) -> Column:
    return F.coalesce(P.prop_number(m, name) < value, F.lit(False))


def before(m: Column | str, name: str, when: dt.datetime | str) -> Column:
    """The property parses as a time earlier than ``when``."""
    text = when if isinstance(when, str) else when.isoformat(sep=" ")
    return F.coalesce(P.prop_timestamp(m, name) < F.lit(text).cast("timestamp_ntz"), F.lit(False))


def after(m: Column | str, name: str, when: dt.datetime | str) -> Column:
    """The property parses as a time later than ``when``."""
    text = when if isinstance(when, str) else when.isoformat(sep=" ")
    return F.coalesce(P.prop_timestamp(m, name) > F.lit(text).cast("timestamp_ntz"), F.lit(False))


def event_is(
    selectors: Mapping[str, str] | str | Iterable[Mapping[str, str] | str] | None,
    column: Column | str = "event",
) -> Column:
    """Any of the named events; none given = all events.

    Accepts a name, ``{"event": name}``, or a list of either.
    """
    if selectors is None:
        return F.lit(True)
    if isinstance(selectors, (str, Mapping)):
        selectors = [selectors]
    names = [s["event"] if isinstance(s, Mapping) else s for s in selectors]
    return P._col(column).isin(names) if names else F.lit(True)


def any_of(predicates: Column | Iterable[Column] | None) -> Column:
    """A profile matches when any selector does; none given = all profiles."""
    if predicates is None:
        return F.lit(True)
    if isinstance(predicates, Column):
        return predicates
    predicates = list(predicates)
    return reduce(lambda a, b: a | b, predicates) if predicates else F.lit(True)
