"""Numbered rows and fixed-size batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

# Fixed value: items per delivered batch.
BATCH_SIZE = 2000


def number_rows(df: DataFrame, order_by: list[str], out: str = "row_no") -> DataFrame:
    """Number all rows from 0 in the order of ``order_by``.

    The rows are range-partitioned and sorted, and written once with their
    partition and place in it, so that numbers cannot change when a task runs
    again. Numbers then come from the row counts of the partitions before: a
    table of one row per partition, which is what the window below runs over.
    """
    placed = (
        df.repartitionByRange(*[F.col(c) for c in order_by])
        .sortWithinPartitions(*order_by)
        # High bits: partition, low 33 bits: place in the partition.
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed, "rows")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    ) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    return (
        placed.withColumn("_part", part)
        # One row per partition of the write: bounded by the number of tasks.
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_at", "_before")
    )


def number_batches(
    df: DataFrame, order_by: list[str], size: int = BATCH_SIZE, out: str = "batch_no"
) -> DataFrame:
    """Rows with ``row_no`` and the number of their batch; only the last is partial."""
    numbered = number_rows(df, order_by)
    return numbered.withColumn(out, F.expr(f"row_no div {int(size)}"))


def batch_payloads(
    numbered: DataFrame, item: Column | str, encode: bool = True, batch: str = "batch_no"
) -> DataFrame:
    """One row per batch: ``batch_no, n_items, payload``.

    ``item`` is each row's JSON text. The payload is a JSON array in row order,
    in base64 when ``encode`` (all endpoints but event import). A batch has a
    fixed number of rows, so collecting it is bounded.
    """
    item = F.col(item) if isinstance(item, str) else item
    rows = F.array_sort(F.collect_list(F.struct("row_no", item.alias("item"))))
    joined = F.concat(
        F.lit("["), F.array_join(F.transform("rows", lambda r: r["item"]), ","), F.lit("]")
    )
    # Spark breaks base64 into lines; receivers want one.
    payload = F.translate(F.base64(joined.cast("binary")), "\r\n", "") if encode else joined
    return (
        numbered.groupBy(batch)
        .agg(rows.alias("rows"))
        .select(batch, F.size("rows").cast("bigint").alias("n_items"), payload.alias("payload"))
    )
