"""JSON arrays and CSV with newlines in cells, read by many tasks per file.

Whether a byte is inside a string cannot be told from the bytes around it. So
a file is cut into blocks, and each block but the last is scanned once for what it does
to that state, whatever the state before it; a running sum over the blocks of a
file (a row each) then gives the state at the start of each. With it a task
finds the items that begin in its block and reads on to the end of the last.
Memory is that of a block, or of an item if one is larger.

Files that cannot be opened in the middle (``.gz``) are one block, read as a stream.
"""

from __future__ import annotations

import csv
import gzip
import io
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import ship_package
from .files import file_tasks, list_files, open_file

BLOCK_BYTES = 32 << 20
_CHUNK = 1 << 20
_BATCH_BYTES = 8 << 20
_BOM = b"\xef\xbb\xbf"
_QUOTE, _SLASH, _NEWLINE = 34, 92, 10
_BLOCK = "path string, start bigint, end bigint, length bigint"

#: What bytes do outside of strings in JSON: open or close a level, or part items.
_COMMA = 2
_KIND = np.zeros(256, np.int8)
_KIND[[ord("["), ord("{")]] = 1
_KIND[[ord("]"), ord("}")]] = -1
_KIND[ord(",")] = _COMMA


def blocks(spark: SparkSession, paths, block_bytes: int) -> DataFrame:
    """``path, start, end, length`` of the blocks of all files under ``paths``."""
    whole = F.col("path").endswith(".gz")
    size = F.when(whole, F.greatest("length", F.lit(1))).otherwise(F.lit(block_bytes))
    return (
        list_files(spark, paths)
        .where("length > 0")
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, size)))
        .select("path", "start", F.least(F.col("start") + size, "length").alias("end"), "length")
    )


def _dealt(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Blocks over the tasks of a shuffle: their rows are too short for adaptive execution to tell."""
    return found.repartition(file_tasks(spark), "path", "start")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _over_before(value: Column) -> Column:
    """Over the blocks of the same file before a block; 0 for the first."""
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(value.over(before), F.lit(0)).cast("bigint")


def _before(column: str) -> Column:
    return _over_before(F.sum(column))


# ----------------------------------------------------------------- JSON arrays


class _JsonState:
    """Where a scan of JSON stands: in a string or not, how deep, behind how many backslashes."""

    def __init__(self, in_string: int = 0, depth: int = 0, slashes: int = 0):
        self.in_string, self.depth, self.slashes = in_string, depth, slashes

    def scan(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, kinds and depths behind them of the brackets and commas outside of strings."""
        codes = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(codes == _QUOTE)
        slash = codes == _SLASH
        if self.slashes or slash.any():
            plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(codes))))
            last = np.where(quotes > 0, plain[quotes - 1], -1)
            run = quotes - 1 - last + np.where(last < 0, self.slashes, 0)
            quotes = quotes[run % 2 == 0]
            trailing = len(codes) - 1 - plain[-1]
            self.slashes = int(trailing + (self.slashes if plain[-1] < 0 else 0)) & 1
        kinds = _KIND[codes]
        at = np.flatnonzero(kinds)
        at = at[(np.searchsorted(quotes, at) + self.in_string) % 2 == 0]
        kinds = kinds[at]
        depths = self.depth + np.cumsum(np.where(kinds == _COMMA, 0, kinds), dtype=np.int64)
        self.in_string = (self.in_string + len(quotes)) & 1
        self.depth = int(depths[-1]) if len(depths) else self.depth
        return at, kinds, depths


def _slashes_before(file: pa.NativeFile, at: int) -> int:
    """Whether an odd number of backslashes ends at ``at``."""
    count = 0
    while at > count:
        size = min(4096, at - count)
        part = file.read_at(size, at - count - size)
        kept = len(part.rstrip(b"\\"))
        count += size - kept
        if kept:
            break
    return count & 1


def _json_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does: quotes, and levels opened if it starts outside or inside of a string."""
    for row in _each(batches):
        with open_file(row["path"]) as file:
            slashes = _slashes_before(file, row["start"])
            states = [_JsonState(in_string, 0, slashes) for in_string in (0, 1)]
            for at in range(row["start"], row["end"], _CHUNK):
                data = file.read_at(min(_CHUNK, row["end"] - at), at)
                for state in states:
                    state.scan(data)
        row |= {"quotes": states[0].in_string, "outside": states[0].depth, "inside": states[1].depth}
        yield pa.RecordBatch.from_pylist([row])


def _is_array(head: bytes) -> bool:
    return head.removeprefix(_BOM).lstrip()[:1] == b"["


def _items(chunks: Iterator[bytes], start: int, end: float, state: _JsonState) -> Iterator[tuple[bytes, bool]]:
    """Items whose left border lies between ``start`` and ``end``, and whether their right border was met."""
    held: list[bytes] | None = None
    at = start
    for data in chunks:
        places, kinds, depths = state.scan(data)
        opens = (kinds == 1) & (depths == 1)
        closes = (kinds == -1) & (depths == 0)
        borders = opens | closes | ((kinds == _COMMA) & (depths == 1))
        left = 0
        for place, closing in zip(places[borders].tolist(), closes[borders].tolist()):
            if held is not None:
                yield b"".join([*held, data[left:place]]), True
            held = [] if not closing and at + place < end else None
            left = place + 1
        if held is not None:
            held.append(data[left:])
        at += len(data)
        if at >= end and held is None:
            return
    if held is not None:
        yield b"".join(held), False


def _chunks_at(file: pa.NativeFile, start: int, length: int) -> Iterator[bytes]:
    for at in range(start, length, _CHUNK):
        yield file.read_at(min(_CHUNK, length - at), at)


def _items_of(row: dict) -> Iterator[tuple[bytes, bool]]:
    with open_file(row["path"]) as file:
        if row["path"].endswith(".gz"):
            stream = gzip.open(file)
            head = stream.peek(4096)[:4096]
            if _is_array(head):
                yield from _items(iter(lambda: stream.read(_CHUNK), b""), 0, float("inf"), _JsonState())
            else:
                yield stream.read().removeprefix(_BOM), True
            return
        if not _is_array(file.read_at(min(4096, row["length"]), 0)):
            if row["start"] == 0:
                yield file.read_at(row["length"], 0).removeprefix(_BOM), True
            return
        state = _JsonState(row["in_string"], row["depth"], _slashes_before(file, row["start"]))
        yield from _items(_chunks_at(file, row["start"], row["length"]), row["start"], row["end"], state)


def _json_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, whole, held = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(whole, pa.bool_())], ["record", "whole"])

    for row in _each(batches):
        for item, complete in _items_of(row):
            if item := item.strip():
                texts.append(item.decode("utf-8", "replace"))
                whole.append(complete)
                held += len(item)
            if held >= _BATCH_BYTES:
                yield batch()
                texts, whole, held = [], [], 0
    if texts:
        yield batch()


def json_items(spark: SparkSession, paths, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``record, whole``: the text of each item of files that hold one JSON array, or one object.

    ``whole`` is off for an item that the end of its file cuts off.
    """
    ship_package(spark)
    found = blocks(spark, paths, block_bytes)
    scanned = _dealt(spark, found.where(F.col("end") < F.col("length"))).mapInArrow(
        _json_effects, f"{_BLOCK}, quotes bigint, outside bigint, inside bigint"
    )
    placed = found.join(scanned.select("path", "start", "quotes", "outside", "inside"), ["path", "start"], "left")
    stated = placed.withColumn("in_string", _before("quotes") % 2).withColumn(
        "levels", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    )
    ready = stated.select("path", "start", "end", "length", "in_string", _before("levels").alias("depth"))
    return _dealt(spark, ready).mapInArrow(_json_records, "record string, whole boolean")


# ----------------------------------------------------------------- CSV


def _quote_runs(codes: np.ndarray, before: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where odd runs of quotes start, which of them open a cell, and which cannot.

    A quote opens a cell only at its beginning, and closes one only if no
    other follows, so a run of an even number changes nothing. An odd one swaps
    inside and outside at the beginning of a cell; elsewhere it leaves the cell.
    ``before`` is the byte before the first, ``None`` at the start of a file.
    """
    quotes = np.flatnonzero(codes == _QUOTE)
    if not len(quotes):
        return quotes, quotes > 0, quotes > 0
    first = np.concatenate([[True], np.diff(quotes) > 1])
    starts = quotes[first]
    lengths = np.diff(np.append(np.flatnonzero(first), len(quotes)))
    ahead = np.where(starts > 0, codes[starts - 1], ord("\n") if before is None else before)
    # A run that began before these bytes is another block's.
    odd = (lengths % 2 == 1) & (ahead != _QUOTE)
    opens = np.isin(ahead, [ord(","), _NEWLINE, ord("\r")])
    return starts[odd], opens[odd], ~opens[odd]


def _states_after(opens: np.ndarray, leaves: np.ndarray, inside: int) -> np.ndarray:
    """Inside or outside of quotes before the first and behind each run."""
    swaps = np.concatenate([[0], np.cumsum(opens)])
    at_leave = np.maximum.accumulate(np.concatenate([[-1], np.where(leaves, swaps[1:], -1)]))
    return np.where(at_leave >= 0, swaps - at_leave, swaps + inside) % 2


def _read_block(file: pa.NativeFile, start: int, end: int, length: int) -> tuple[np.ndarray, int | None]:
    """Bytes of a block, with the rest of a run of quotes at its end, and the byte before."""
    data = file.read_at(end - start, start)
    while end < length and data.endswith(b'"'):
        more = file.read_at(min(4096, length - end), end)
        rest = more[: len(more) - len(more.lstrip(b'"'))]
        data += rest
        end += len(rest)
        if len(rest) < len(more):
            break
    if start == 0:
        # A mark of the byte order is no part of the first cell.
        return np.frombuffer(b"\n" * 3 + data[3:] if data.startswith(_BOM) else data, np.uint8), None
    return np.frombuffer(data, np.uint8), file.read_at(1, start - 1)[0]


def _csv_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a block leaves quotes whatever is before it, and how often it swaps after that."""
    for row in _each(batches):
        with open_file(row["path"]) as file:
            codes, before = _read_block(file, row["start"], row["end"], row["length"])
        _, opens, leaves = _quote_runs(codes, before)
        last = np.flatnonzero(leaves)
        row |= {"leaves": len(last) > 0, "swaps": int(opens[last[-1] :].sum() if len(last) else opens.sum()), "all_swaps": int(opens.sum())}
        yield pa.RecordBatch.from_pylist([row])


def _own_rows(file: pa.NativeFile, row: dict) -> str:
    """Text of the rows that begin in a block."""
    start, end, length = row["start"], row["end"], row["length"]
    upto = min(length, end + (64 << 10))
    while True:
        codes, before = _read_block(file, start, upto, length)
        runs, opens, leaves = _quote_runs(codes, before)
        newlines = np.flatnonzero(codes == _NEWLINE)
        states = _states_after(opens, leaves, row["inside"])
        borders = newlines[states[np.searchsorted(runs, newlines)] == 0]
        ends = borders[borders >= end - start - 1]
        if len(ends) or start + len(codes) >= length:
            break
        upto = min(length, upto + 2 * (upto - end))
    begins = 0 if start == 0 or (before == _NEWLINE and row["inside"] == 0) else None
    if begins is None:
        own = borders[borders < end - start - 1]
        if not len(own):
            return ""
        begins = int(own[0]) + 1
    stop = int(ends[0]) + 1 if len(ends) else len(codes)
    return codes[begins:stop].tobytes().decode("utf-8", "replace")


def _table(text: io.TextIOBase) -> Iterator[list[str]]:
    csv.field_size_limit((1 << 31) - 1)
    return (cells for cells in csv.reader(text) if cells)


def _open_text(file: pa.NativeFile, path: str) -> io.TextIOBase:
    stream = gzip.open(file) if path.endswith(".gz") else file
    return io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")


def _header(path: str) -> list[str]:
    with open_file(path) as file:
        return next(_table(_open_text(file, path)), [])


def _rows_of(row: dict) -> Iterator[list[str]]:
    with open_file(row["path"]) as file:
        if row["path"].endswith(".gz"):
            yield from islice(_table(_open_text(file, row["path"])), 1, None)
            return
        text = _own_rows(file, row)
    rows = _table(io.StringIO(text.lstrip("\n") if row["start"] == 0 else text, newline=""))
    yield from islice(rows, 1 if row["start"] == 0 else 0, None)


def _csv_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        names, cells, ends, held = [], [], [0], 0
        header = _header(row["path"])

        def batch() -> pa.RecordBatch:
            maps = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names, pa.string()), pa.array(cells, pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(maps)), maps], ["path", "cells"])

        for found in _rows_of(row):
            kept = {name: cell for name, cell in zip(header, found) if cell}
            names += kept.keys()
            cells += kept.values()
            ends.append(len(names))
            held += sum(map(len, found))
            if held >= _BATCH_BYTES:
                yield batch()
                names, cells, ends, held = [], [], [0], 0
        if len(ends) > 1:
            yield batch()


def csv_rows(spark: SparkSession, paths, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, cells``: each row's cells that are not empty, by the names in its file's own header.

    Quotes in a quoted cell are doubled, and it may hold newlines; a quote
    within another cell is itself. Cells beyond the header are left out, blank lines
    too. Of columns of one name the last that is not empty counts.
    """
    ship_package(spark)
    found = blocks(spark, paths, block_bytes)
    scanned = _dealt(spark, found.where(F.col("end") < F.col("length"))).mapInArrow(
        _csv_effects, f"{_BLOCK}, leaves boolean, swaps bigint, all_swaps bigint"
    )
    placed = found.join(scanned.select("path", "start", "leaves", "swaps", "all_swaps"), ["path", "start"], "left")
    # Swaps so far, less those up to the last block that left quotes: both only grow.
    so_far = placed.withColumn("before", _before("all_swaps")).withColumn(
        "cleared", F.when(F.col("leaves"), F.col("before") + F.col("all_swaps") - F.col("swaps"))
    )
    cleared = _over_before(F.max("cleared"))
    ready = so_far.select("path", "start", "end", "length", ((F.col("before") - cleared) % 2).alias("inside"))
    return _dealt(spark, ready).mapInArrow(_csv_records, "path string, cells map<string,string>")


_HEADERS = pa.schema([("path", pa.string()), ("header", pa.list_(pa.string()))])


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        yield pa.RecordBatch.from_pylist([{"path": row["path"], "header": _header(row["path"])}], _HEADERS)


def csv_headers(spark: SparkSession, paths) -> DataFrame:
    """``path, header`` of each file; no more than its first row is read."""
    ship_package(spark)
    listed = list_files(spark, paths).where("length > 0").select("path")
    return listed.repartition(file_tasks(spark), "path").mapInArrow(_headers, "path string, header array<string>")
