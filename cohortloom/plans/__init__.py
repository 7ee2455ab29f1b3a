"""All registered queries."""

from . import events, files, migration, profiles, streams
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "events", "files", "migration", "profiles", "streams"]
