"""Exact dedup against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.workspace import write_parquet

_INDEX = "digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING, batch_rows BIGINT"


def text_digest(text: Column | str) -> Column:
    """SHA-256 of a text as 32 bytes; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class DigestIndex:
    """All texts seen so far, one row per digest, in ``buckets`` sorted buckets under ``path``.

    The index lives in files: another session opens it by the same path and
    number of buckets. ``add`` dedups a batch of new rows:

    1. the rows' (id, digest) go to the log of the batch, so no later step
       reads a text again;
    2. rows are counted per digest with map-side partial aggregation, so a text
       that makes up a third of all rows is one row per task in the shuffle;
    3. a sort-merge anti-join leaves the digests the index lacks. The index side
       is read bucket by bucket without a shuffle, if there are no fewer buckets
       than ``spark.sql.shuffle.partitions``;
    4. these are appended, again one sorted file per bucket.

    A batch that is added again finds its digests present and appends nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({_INDEX}) USING PARQUET "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{self.path}/index'"
        )

    def close(self) -> None:
        """Forget the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def add(self, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Dedup ``rows`` against the index and among themselves; one decision per row.

        Of equal texts in the batch the row with the greatest id stays (null ids
        last; of rows that also share the id, exactly one stays), unless an
        earlier batch has the text: then none stays. Returns ``id_col, keep_id``
        (id of the row that stays, perhaps of an earlier batch), ``group_size``
        (rows of the batch with this text), ``kept``, ``digest``. Other columns
        of ``rows`` are ignored; a null text counts as empty; no rows give none.
        """
        batch = uuid.uuid4().hex
        log = write_parquet(
            rows.select(
                F.col(id_col).cast("long").alias("id"),
                text_digest(text_col).alias("digest"),
                F.monotonically_increasing_id().alias("row"),
            ),
            f"{self.path}/log/{batch}",
        )
        groups = log.groupBy("digest").agg(
            F.max(F.struct("id", (-F.col("row")).alias("minus_row"))).alias("best"),
            F.count("*").alias("batch_rows"),
        )
        index = self.spark.table(self.table)
        # The count in the condition, always true, keeps Spark from moving the join
        # below the aggregate, where every copy of a hot text would be shuffled.
        seen = index.select("digest").hint("merge")
        new = groups.join(seen, (groups["digest"] == seen["digest"]) & (groups["batch_rows"] > 0), "left_anti")
        (
            new.select(
                "digest",
                F.col("best.id").alias("keep_id"),
                (-F.col("best.minus_row")).alias("keep_row"),
                F.lit(batch).alias("batch"),
                "batch_rows",
            )
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/index")
            .format("parquet")
            .saveAsTable(self.table)
        )
        return self._decisions(log, batch, id_col)

    def _decisions(self, log: DataFrame, batch: str, id_col: str) -> DataFrame:
        # Read as plain files: a join with two ordinary shuffles is one whose
        # hot digests adaptive execution splits over several tasks.
        index = self.spark.read.schema(_INDEX).parquet(f"{self.path}/index")
        own = F.col("batch") == batch
        joined = log.join(index, "digest")
        if_later = log.groupBy("digest").agg(F.count("*").alias("rows_here"))
        sized = (
            joined
            if self._is_first(index, batch)
            else joined.join(if_later, "digest").withColumn("batch_rows", F.col("rows_here"))
        )
        return sized.select(
            F.col("id").alias(id_col),
            "keep_id",
            F.col("batch_rows").alias("group_size"),
            (own & (F.col("row") == F.col("keep_row"))).alias("kept"),
            "digest",
        )

    @staticmethod
    def _is_first(index: DataFrame, batch: str) -> bool:
        """Whether all digests come from this batch, so that its counts are stored with them."""
        return index.filter(F.col("batch") != batch).isEmpty()
