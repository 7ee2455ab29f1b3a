"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.near_dedup import _lists
from cohortloom.llm.words import HashedWords, as_bytes, shingle_set
from cohortloom.llm.workspace import Workspace
from cohortloom.session import ship_package

#: Shingles of test items that are held by every task at once; more are searched in further blocks.
BLOCK_SHINGLES = 1_000_000
#: Bins of a sketch per possible shingle of a document of its size class.
_BINS_PER_SHINGLE = 4
#: Items of fewer shingles are looked up by all of them, as sketches of so few could miss.
_SMALL_ITEM = 16


class Items(NamedTuple):
    """A block of test items: their ids, and their sorted shingles one after another."""

    ids: np.ndarray
    ends: np.ndarray
    shingles: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.shingles[self.ends[i] : self.ends[i + 1]]


def size_class(n: int) -> int:
    """Documents of up to ``2 ** size_class`` shingles share the number of bins."""
    return max(0, int(n - 1).bit_length())


def bin_minima(shingles: np.ndarray, cls: int) -> np.ndarray:
    """One-permutation MinHash: the least shingle of each bin, for ascending ones.

    A shingle's leading bits are its bin, the rest its rank, so the sketch of a
    sorted set is the first shingle of each run of equal bins.
    """
    shift = np.uint64(64 - min(63, cls + _BINS_PER_SHINGLE.bit_length() - 1))
    bins = shingles >> shift
    return shingles[np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))] if len(shingles) else shingles


class ItemIndex:
    """Sketches of a block of items, per size class of the documents, made when first needed."""

    def __init__(self, items: Items):
        self.items = items
        self.by_class: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _keys(self, cls: int) -> tuple[np.ndarray, np.ndarray]:
        if cls not in self.by_class:
            each = [self.items.of(i) for i in range(len(self.items.ids))]
            kept = [s if len(s) < _SMALL_ITEM else bin_minima(s, cls) for s in each]
            keys = np.concatenate(kept) if kept else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
            order = np.argsort(keys, kind="stable")
            self.by_class[cls] = keys[order], owner[order]
        return self.by_class[cls]

    def search(self, shingles: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
        """(place of the item, shared shingles, its shingles) of those contained."""
        if not len(shingles):
            return []
        cls = size_class(len(shingles))
        keys, owner = self._keys(cls)
        candidates: set[int] = set()
        for probe in (bin_minima(shingles, cls), shingles):
            low, high = np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right")
            for a, b in zip(low[low < high], high[low < high]):
                candidates.update(owner[a:b].tolist())
            if len(probe) == len(shingles) or not self.has_small:
                break
        found = []
        for i in sorted(candidates):
            item = self.items.of(i)
            at = np.minimum(np.searchsorted(shingles, item), len(shingles) - 1)
            shared = int((shingles[at] == item).sum())
            if 100 * shared >= percent * len(item):
                found.append((i, shared, len(item)))
        return found

    @property
    def has_small(self) -> bool:
        return bool((np.diff(self.items.ends) < _SMALL_ITEM).any())


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, shingles`` (sorted as unsigned) of the items that have words and an id."""
    ship_package(items.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = HashedWords()
        for batch in batches:
            sets = [shingle_set(t, words) for t in as_bytes(batch.column(1))]
            full = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(full, pa.int64())), _lists([sets[i].view(np.int64) for i in full], pa.int64())],
                ["item_id", "shingles"],
            )

    rows = items.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string")
    )
    return rows.mapInArrow(task, "item_id long, shingles array<long>")


def item_blocks(work: Workspace, items: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> Iterator[Broadcast]:
    """The items as broadcast blocks of about ``block_shingles`` shingles each."""
    shingles = work.cut(item_shingles(items))
    total = shingles.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = -(-total // block_shingles)
    for b in range(blocks):
        part = shingles.filter(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == b).toArrow()
        values = part.column("shingles").combine_chunks()
        yield work.spark.sparkContext.broadcast(
            Items(
                part.column("item_id").to_numpy(),
                np.concatenate([[0], np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64),
                values.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
            )
        )


def find_contained(
    work: Workspace, docs: DataFrame, items: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item``: items of whose five-word shingles a document has ``percent``.

    The items are a stated query set: each block of them is broadcast, of bounded
    size, and searched in all documents, which are neither shuffled nor paired.
    A document's sketch has bins in proportion to its size class, and so has the
    sketch an item takes for that class; a shared shingle is the least of its
    bin in both with a probability of 0.8 or more. An item of 16 shingles of
    which 13 are shared is thus missed with a probability below 1e-8; smaller ones
    are looked up by all shingles. Candidates are verified on the full sets.

    An item of fewer than five words is one shingle, found only in a document
    that consists of the same words. Null or empty texts contain nothing and are
    in nothing; items without an id are ignored; rows of ``docs`` that repeat, or
    have a null id, give a row each. No items or no documents give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    found = None
    for shared in item_blocks(work, items):

        def task(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            index, words = ItemIndex(shared.value), HashedWords()
            for batch in batches:
                out = [
                    (row, int(index.items.ids[i]), n, size)
                    for row, text in enumerate(as_bytes(batch.column(1)))
                    for i, n, size in index.search(shingle_set(text, words), percent)
                ]
                if out:
                    row, item, n, size = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), pa.array(item), pa.array(n), pa.array(size)],
                        ["doc_id", "item_id", "n_shared", "n_item"],
                    )

        block = rows.mapInArrow(task, schema)
        found = block if found is None else found.unionByName(block)
    return spark.createDataFrame([], schema) if found is None else found


def drop_contaminated(
    work: Workspace, docs: DataFrame, items: DataFrame, percent: int = 80, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain none of the items; nothing is shuffled."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    for shared in item_blocks(work, items):

        def task(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            index, words = ItemIndex(shared.value), HashedWords()
            for batch in batches:
                clean = [not index.search(shingle_set(t, words), percent) for t in as_bytes(batch.column(at))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(task, docs.schema)
    return docs
