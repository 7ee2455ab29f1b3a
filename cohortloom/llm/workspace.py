"""Written cuts in the shared folder, with an owner that deletes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import scratch_path

#: Shuffle files of a finished write are of no further use; Spark can drop them at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder: one file or a folder of parts."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back; the shuffles behind the write go when it has ended."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """A folder of one operator call under ``spark.checkpoint.dir``.

    ``cut`` writes a table that is read again within the call and deleted when
    the ``with`` block ends; ``result`` writes the table the returned DataFrame
    reads, which therefore stays, under ``self.kept``, until its owner deletes it.
    Written tables survive lost executors and give every reader the same rows.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_path(spark, label)
        self.kept = f"{self.path}-result"
        self._cuts = self._results = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        delete_path(self.spark, self.path)

    def cut(self, df: DataFrame) -> DataFrame:
        self._cuts += 1
        made = write_parquet(df, path := f"{self.path}/{self._cuts}")
        self._paths[id(made)] = made, path
        return made

    def forget(self, cut: DataFrame) -> None:
        """Delete a cut that is not read again, ahead of the others."""
        delete_path(self.spark, self._paths.pop(id(cut))[1])

    def result(self, df: DataFrame, name: str = "rows") -> DataFrame:
        self._results += 1
        return write_parquet(df, f"{self.kept}/{name}-{self._results}")
