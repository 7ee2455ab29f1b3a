"""Opening files inside tasks by the path Spark lists them under."""

from __future__ import annotations


import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def list_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``path, length`` of the files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def file_tasks(spark: SparkSession) -> int:
    """Tasks over which files are dealt that Python opens: as many as a shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def list_folder(path: str) -> list[str]:
    """Paths of the data files of one folder, as :func:`open_file` takes them."""
    store, inner = _locate(path)
    found = store.get_file_info(fs.FileSelector(inner))
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted(prefix + f.path for f in found if f.is_file and f.size and f.base_name[0] not in "._")


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_file(path: str) -> pa.NativeFile:
    """A seekable file of any store Arrow knows (local, HDFS, S3, GCS)."""
    store, inner = _locate(path)
    return store.open_input_file(inner)


def create_file(path: str) -> pa.NativeFile:
    """A new file to write, its folder made where the store has folders."""
    store, inner = _locate(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inner)
