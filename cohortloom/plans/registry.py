"""Registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable[[Plan], Plan]:
    """Register a query under its function's name, with its SQL."""

    def register(fn: Plan) -> Plan:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return register
