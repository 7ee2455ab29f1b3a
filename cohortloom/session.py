"""Session-level helpers: the shared work folder and lineage cuts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent and the session is a local one (tests, a
    laptop) is a temporary folder made; on a cluster that would be a folder
    other executors cannot see, so the missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="cohortloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under a folder, in order; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def owned_cuts(spark: SparkSession) -> Iterator[None]:
    """Delete the cuts made in this block at its end.

    For what ends in a write: a DataFrame that reads a cut must not leave the
    block. An inner block deletes its own cuts.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives lost executors, keeps the schema, and gives
    every later reader the same rows, which a recomputed plan with
    partition-dependent columns would not. It stays until its owner
    (:func:`owned_cuts`) or the caller deletes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for the few tasks that run Python.

    Spark distributes the archive itself. Not needed where the package is
    installed on all nodes or given to ``spark-submit --py-files``.
    """
    if spark.conf.get("spark.cohortloom.shipped", None):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='cohortloom-')}/{package.name}", "zip", package.parent, package.name
    )
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.cohortloom.shipped", "true")
