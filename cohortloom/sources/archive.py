"""Zip archives of gzipped JSON lines, read member by member."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .files import file_tasks, list_files, open_file

_LINES_PER_BATCH = 5000


def _members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for path in frame["path"]:
            # Only the directory at the end of the archive is read here.
            with open_file(path) as raw, zipfile.ZipFile(raw) as archive:
                rows += [(path, name) for name in sorted(archive.namelist()) if name.endswith(".gz")]
        yield pd.DataFrame(rows, columns=["path", "member"])


def _lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, member in zip(frame["path"], frame["member"]):
            with open_file(path) as raw, zipfile.ZipFile(raw) as archive:
                with archive.open(member) as packed, gzip.open(packed) as plain:
                    batch: list[str] = []
                    for line in io.TextIOWrapper(plain, encoding="utf-8"):
                        if line.strip():
                            batch.append(line.rstrip("\r\n"))
                        if len(batch) == _LINES_PER_BATCH:
                            yield pd.DataFrame({"record": batch})
                            batch = []
                    if batch:
                        yield pd.DataFrame({"record": batch})


def read_zip_records(spark: SparkSession, path, glob: str = "*.zip") -> DataFrame:
    """Lines of every ``.gz`` member of every archive, as text in ``record``.

    Members, not archives, are dealt over the tasks, and each is streamed, so
    one large archive neither fills a task's memory nor keeps one task busy alone.
    """
    tasks = file_tasks(spark)
    members = list_files(spark, path, glob).select("path").repartition(tasks, "path").mapInPandas(
        _members, "path string, member string"
    )
    return members.repartition(tasks, "path", "member").mapInPandas(_lines, "record string")
