"""Delivering batches to another system through a caller-supplied function.

``send(payload)`` runs inside tasks and gets one batch at a time. Tasks may run
again, so a batch can arrive more than once: batches are numbered from written
rows and keep their number and content, which lets the receiver drop repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.batches import BATCH_SIZE, batch_payloads, number_batches
from ..session import child_names, owned_cuts, ship_package
from ..sources.files import create_file, file_tasks, list_files

RESULT_SCHEMA = "batch_no bigint, n_items bigint, ok boolean, error string, payload string"


def send_batches(payloads: DataFrame, send: Callable[[str], None], results_path: str) -> DataFrame:
    """Send every payload and write one result row per batch.

    A batch whose ``send`` raises yields ``ok = false``, the error and the
    payload; it neither stops the others nor gets lost. The results are written
    before anything reads them, so reading them twice sends nothing twice.
    """

    def deliver(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for batch_no, n_items, payload in zip(
                frame["batch_no"], frame["n_items"], frame["payload"]
            ):
                error = None
                try:
                    send(payload)
                except Exception as e:  # noqa: BLE001 - any failure is a result row
                    error = f"{type(e).__name__}: {e}"
                rows.append((batch_no, n_items, error is None, error, payload if error else None))
            yield pd.DataFrame(rows, columns=["batch_no", "n_items", "ok", "error", "payload"])

    payloads.mapInPandas(deliver, RESULT_SCHEMA).write.mode("errorifexists").parquet(results_path)
    return payloads.sparkSession.read.schema(RESULT_SCHEMA).parquet(results_path)


def deliver(
    df: DataFrame,
    item: Column | str,
    order_by: list[str],
    send: Callable[[str], None],
    results_path: str,
    size: int = BATCH_SIZE,
    encode: bool = True,
) -> DataFrame:
    """Number, batch, encode and send the rows; returns the result rows."""
    numbered = number_batches(df, order_by, size)
    return send_batches(batch_payloads(numbered, item, encode), send, results_path)


def failed_batches(results: DataFrame) -> DataFrame:
    """Batches to send again."""
    return results.where(~F.col("ok")).select("batch_no", "n_items", "payload", "error")


#: Folders over which receipts are dealt, so that none lists them all.
_RECEIPT_FOLDERS = 64


class Delivery:
    """A delivery under ``path`` that can run again until every batch has arrived.

    ``prepare`` writes the numbered batches once; whoever calls it again gets those that
    are there. A task leaves a receipt, a file named by the batch, as soon as ``send`` has
    returned, so what a run that ended early has sent is known. ``run`` sends the
    batches without a receipt. A batch is sent twice only if a task ends between the two.

    Layout: ``batches/`` (payloads), ``receipts/<folder>/<batch number>``, ``failures/run=<n>/``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def prepare(
        self, df: DataFrame, item: Column | str, order_by: list[str], size: int = BATCH_SIZE, encode: bool = True
    ) -> None:
        """Number, batch and write the rows, unless that is done already."""
        if "_SUCCESS" in child_names(self.spark, f"{self.path}/batches"):
            return
        with owned_cuts(self.spark):
            payloads = batch_payloads(number_batches(df, order_by, size), item, encode)
            payloads.write.mode("overwrite").parquet(f"{self.path}/batches")

    @property
    def batches(self) -> DataFrame:
        """``batch_no, n_items, payload`` of all batches."""
        return self.spark.read.parquet(f"{self.path}/batches")

    def receipts(self) -> DataFrame:
        """``batch_no`` of the batches that have arrived."""
        if not child_names(self.spark, f"{self.path}/receipts"):
            return self.spark.createDataFrame([], "batch_no bigint")
        found = list_files(self.spark, f"{self.path}/receipts")
        return found.select(F.regexp_extract("path", "/([0-9]+)$", 1).cast("bigint").alias("batch_no"))

    def pending(self) -> DataFrame:
        """Batches without a receipt."""
        return self.batches.join(self.receipts(), "batch_no", "left_anti")

    def run(self, send: Callable[[str], None]) -> DataFrame:
        """Send what is pending; returns :meth:`results`.

        A batch whose ``send`` raises is noted and left for the next run; the others go on.
        """
        ship_package(self.spark)
        receipts = f"{self.path}/receipts"

        def deliver(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                errors = []
                for batch_no, payload in zip(frame["batch_no"], frame["payload"]):
                    try:
                        send(payload)
                    except Exception as e:  # noqa: BLE001 - any failure is a result row
                        errors.append((batch_no, f"{type(e).__name__}: {e}"))
                        continue
                    with create_file(f"{receipts}/{batch_no % _RECEIPT_FOLDERS}/{batch_no}") as receipt:
                        receipt.write(b"sent")
                yield pd.DataFrame(errors, columns=["batch_no", "error"]).astype({"batch_no": "int64", "error": "object"})

        failures = f"{self.path}/failures"
        number = len(child_names(self.spark, failures))
        pending = self.pending().select("batch_no", "payload").repartition(file_tasks(self.spark), "batch_no")
        pending.mapInPandas(deliver, "batch_no bigint, error string").write.parquet(f"{failures}/run={number}")
        return self.results()

    def results(self) -> DataFrame:
        """Per batch ``batch_no, n_items, ok, error, payload``; the latest error and the payload of those not arrived."""
        failed = self.spark.read.schema("batch_no bigint, error string, run int").parquet(f"{self.path}/failures")
        latest = failed.groupBy("batch_no").agg(F.max_by("error", "run").alias("error"))
        ok = F.col("arrived").isNotNull()
        return (
            self.batches.join(self.receipts().withColumn("arrived", F.lit(True)), "batch_no", "left")
            .join(latest, "batch_no", "left")
            .select("batch_no", "n_items", ok.alias("ok"), *[F.when(~ok, F.col(c)).alias(c) for c in ("error", "payload")])
        )
