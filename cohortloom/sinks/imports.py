"""Imports: files or tables into the events, profiles and groups tables, or onward."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators import events as E
from ..operators import folding, updates as U
from ..operators.groups import Groups
from ..session import cut_lineage
from .delivery import deliver
from .exports import event_json


def import_events(raw: DataFrame, token: str, offset_hours: float = 0) -> DataFrame:
    """Raw events to the events table: valid ones, in UTC, with the token."""
    return E.shape_events(E.prepare_events(raw, token, offset_hours))


def import_profiles(profiles: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Set all properties of the incoming profiles on the stored ones.

    ``order`` names a column deciding which of several rows for one id comes
    later; without it an id must come once.
    """
    if order is not None:
        incoming = U.latest_properties(incoming, order)
    return U.update_from_rows(profiles, incoming, U.SET, "properties")


def import_update_records(profiles: DataFrame, records: DataFrame, order: str) -> DataFrame:
    """Apply raw update records (JSON text in ``record``) in the order of a column."""
    # The fold reads its feed twice; parsing the records is the costly part.
    feed = cut_lineage(U.read_update_records(records, "record", order), "records")
    return folding.apply_updates(profiles, feed)


def import_groups(groups: DataFrame, incoming: DataFrame, context: Groups) -> DataFrame:
    """Set all properties of the incoming group profiles on the stored ones."""
    return context.import_profiles(groups, incoming)


def send_events(
    raw: DataFrame,
    token: str,
    order_by: list[str],
    send: Callable[[str], None],
    results_path: str,
    offset_hours: float = 0,
) -> DataFrame:
    """Deliver prepared events in batches of JSON arrays; returns result rows."""
    ready = E.prepare_events(raw, token, offset_hours)
    lines = event_json(ready, *order_by)
    return deliver(lines, "value", order_by, send, results_path, encode=False)


def send_profiles(
    incoming: DataFrame,
    token: str,
    send: Callable[[str], None],
    results_path: str,
    ignore_alias: bool = False,
) -> DataFrame:
    """Deliver profiles as base64 batches of ``$set`` records; returns result rows."""
    rows = incoming.withColumnRenamed("properties", "value")
    records = U.update_records(rows, token, U.SET, "value", ignore_alias)
    return deliver(records, "record", ["distinct_id"], send, results_path)


__all__ = [
    "import_events",
    "import_groups",
    "import_profiles",
    "import_update_records",
    "send_events",
    "send_profiles",
]
