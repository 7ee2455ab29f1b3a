"""A profiles table that takes batches of updates at the cost of the batch.

The table is a log: a *base* holds whole profiles as they were after some batch, a
*delta* per later batch the folded changes of the profiles it touched
(:func:`..operators.folding.fold_updates`). Writing a batch folds and writes it, and reads
nothing of the table. Reading merges: the deltas of a profile are applied to its
base row in order. Compaction writes what a read gives as the next base.

Layout under ``path``::

    base/upto=<n>/bucket=<b>/     profiles after batch n; -1 before any
    delta/batch=<n>/bucket=<b>/   one row per profile that batch n touched

Rows lie in folders by the hash of their id, so a read of a few profiles opens their
buckets only. A folder counts once Spark has marked its write as finished. A batch that runs
again overwrites its own delta, or is passed over if a base already holds it, so
no update is applied twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import folding
from ..session import child_names, delete_path, owned_cuts

_DONE = "_SUCCESS"


class ProfileStore:
    """The table under ``path``; ``buckets`` must be the same each time it is opened."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets

    @property
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("distinct_id"), F.lit(self.buckets)).cast("int")

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the finished folders ``kind=<n>``, ascending."""
        folder = f"{self.path}/{'base' if kind == 'upto' else 'delta'}"
        found = [n for n in child_names(self.spark, folder) if n.startswith(f"{kind}=")]
        done = [n for n in found if _DONE in child_names(self.spark, f"{folder}/{n}")]
        return sorted(int(n.split("=")[1]) for n in done)

    def _write(self, rows: DataFrame, folder: str) -> None:
        (
            rows.withColumn("bucket", self._bucket)
            .repartition("bucket", F.pmod(F.xxhash64("distinct_id", F.lit(1)), F.lit(16)))
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path}/{folder}")
        )

    def create(self, profiles: DataFrame) -> None:
        """Begin with some profiles: ``distinct_id``, unique, and ``properties``."""
        self._write(profiles.select("distinct_id", "properties"), "base/upto=-1")

    def append(self, updates: DataFrame, batch: int) -> None:
        """Fold and write one batch of ``distinct_id, seq, op, payload``.

        Batches are applied in the order of their numbers, updates within one in
        the order of ``seq``. A number that a base already holds is passed over;
        another that was there is replaced.
        """
        if batch <= self._numbers("upto")[-1]:
            return
        with owned_cuts(self.spark):
            self._write(folding.fold_updates(updates), f"delta/batch={batch}")

    def read(self, ids: DataFrame | None = None) -> DataFrame:
        """Profiles after all batches; of ``ids`` only, which must be few enough to be one task's."""
        upto = self._numbers("upto")[-1]
        base = self.spark.read.parquet(f"{self.path}/base/upto={upto}")
        deltas = self._deltas(upto)
        if ids is not None:
            wanted = ids.select("distinct_id").distinct().withColumn("bucket", self._bucket)
            buckets = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
            base, deltas = (
                df if df is None else df.where(F.col("bucket").isin(buckets)).join(wanted, ["bucket", "distinct_id"], "left_semi")
                for df in (base, deltas)
            )
        profiles = base.select("distinct_id", "properties")
        return profiles if deltas is None else folding.apply_folded(profiles, deltas.drop("bucket"))

    def _deltas(self, upto: int) -> DataFrame | None:
        """All rows of the batches after ``upto``."""
        later = [n for n in self._numbers("batch") if n > upto]
        if not later:
            return None
        paths = [f"{self.path}/delta/batch={n}" for n in later]
        return self.spark.read.option("basePath", f"{self.path}/delta").parquet(*paths)

    def is_due(self, share: float) -> bool:
        """Whether the deltas have at least ``share`` times the rows of the base, by their file footers."""
        upto = self._numbers("upto")[-1]
        deltas = self._deltas(upto)
        if deltas is None:
            return False
        return deltas.count() >= share * self.spark.read.parquet(f"{self.path}/base/upto={upto}").count()

    def compact(self) -> None:
        """Write the profiles after the last batch as a base of their own.

        The base before it and the batches since then stay until the next
        compaction, for readers that have begun with them.
        """
        bases, batches = self._numbers("upto"), self._numbers("batch")
        if not batches or batches[-1] <= bases[-1]:
            return
        self._write(self.read(), f"base/upto={batches[-1]}")
        for old in bases[:-1]:
            delete_path(self.spark, f"{self.path}/base/upto={old}")
        for n in batches:
            if n <= bases[-1]:
                delete_path(self.spark, f"{self.path}/delta/batch={n}")
