"""Group profiles: a handle that fixes the group type and key for later calls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from . import updates as U


@dataclass(frozen=True)
class Groups:
    """Group context: ``group_type`` picks the stored set, ``group_key`` names the key.

    The groups table has ``group_type, group_key, group_id, properties``;
    partition it by ``group_type`` and a scan reads one type only.
    """

    group_type: str | None = None
    group_key: str | None = None

    def scan(self, groups: DataFrame) -> DataFrame:
        if self.group_type is None:
            raise ValueError("group_type is not set")
        return groups.where(F.col("group_type") == self.group_type)

    def update(self, groups: DataFrame, operation: str, value=None, targets=None, matched=None) -> DataFrame:
        """Apply one operation to the groups under this key; others stay."""
        if self.group_key is None:
            raise ValueError("group_key is not set")
        if targets is None and self.group_type is None:
            raise ValueError("give targets, or a group_type to target all of")
        mine = F.col("group_key") == self.group_key
        if self.group_type is not None:
            mine = mine & (F.col("group_type") == self.group_type)
        if not isinstance(targets, DataFrame):
            hit = mine if targets is None else mine & targets
            return U.update(groups, operation, value, hit, U.GROUP_KEYS, matched)
        ids = targets.select(F.lit(self.group_key).alias("group_key"), "group_id")
        out = U.update(groups, operation, value, ids, U.GROUP_KEYS, matched)
        if operation in U.CREATING and self.group_type is not None:
            out = out.withColumn("group_type", F.coalesce("group_type", F.lit(self.group_type)))
        return out

    def set(self, groups: DataFrame, value, targets=None, **kw) -> DataFrame:
        return self.update(groups, U.SET, value, targets, **kw)

    def delete(self, groups: DataFrame, targets=None, **kw) -> DataFrame:
        return self.update(groups, U.DELETE, None, targets, **kw)

    def import_profiles(self, groups: DataFrame, profiles: DataFrame) -> DataFrame:
        """Set every property of ``profiles`` (``group_id, properties``) on its group."""
        if self.group_key is None:
            raise ValueError("group_key is not set")
        rows = profiles.select(
            F.lit(self.group_key).alias("group_key"), "group_id", F.col("properties").alias("value")
        )
        out = U.update_from_rows(groups, rows, U.SET, keys=U.GROUP_KEYS)
        if self.group_type is not None:
            out = out.withColumn("group_type", F.coalesce("group_type", F.lit(self.group_type)))
        return out
