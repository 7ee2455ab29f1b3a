"""Removal of long byte strings that an earlier document has, by sorting sampled suffixes.

Sorting every suffix of a corpus with enough of its text costs fifty times the
corpus in the shuffle. Instead a sample of suffixes is sorted, from which what
holds of the others is induced, in three rounds. In each, tasks that hold a part
of the texts (a chunk) send fixed-width tuples to tasks that hold a range of keys,
which sort them and answer; Spark's shuffle keeps both on disk.

1. Sample: of every 25 neighbouring positions the one whose 26-byte prefix has
   the least hash. So each 50-byte string has a sampled suffix inside, the same
   one wherever the string occurs. A chunk sends each of its prefixes once and
   learns which of them occur in more than one document.
2. Context: a sampled suffix with the 24 bytes before and the 50 after it holds
   all 50-byte strings it can be the sample of. A chunk sends each context once, with
   the least document; where a smaller document has the context, all these
   strings are repeats. It also learns where one prefix has several contexts.
3. Strings: only for those prefixes, and there only in the least document of a
   context, the strings themselves are sent; where a smaller document has one,
   it is a repeat.

Equal keys are what counts, so tuples are sorted by hashes of their bytes. What a
third of all documents share is sent once per chunk. Chunks are files in the
shared folder; texts are not shuffled.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.words import as_bytes, mix64
from cohortloom.llm.workspace import Workspace
from cohortloom.session import ship_package

WINDOW = 50
PREFIX = 26
SPAN = WINDOW - PREFIX + 1
CHUNK_BYTES = 8_000_000
_SLICE = 1 << 17
_NO_ID = np.iinfo(np.int64).min
_TOP = np.uint64(2**64 - 1)
_BASE, _CONTEXT_BASE, _STRING_BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_MESSAGE = "bucket long, chunk string, payload binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

Message = tuple[int, str, bytes]


# ---- tuples in binary form ---------------------------------------------------


def _pack(*fields: np.ndarray) -> bytes:
    """Columns of equal length by bytes of equal weight, which compress well."""
    parts = [np.int64(len(fields[0])).tobytes()]
    for f in fields:
        parts.append(np.ascontiguousarray(f).view(np.uint8).reshape(len(f), f.dtype.itemsize).T.tobytes())
    return b"".join(parts)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return out


def _messages(rows: list[Message]) -> pa.RecordBatch:
    bucket, chunk, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(chunk, pa.string()), pa.array(payload, pa.binary())],
        ["bucket", "chunk", "payload"],
    )


def _save(path: str, **arrays: np.ndarray) -> None:
    held = io.BytesIO()
    np.savez(held, **arrays)
    files, name = pafs.FileSystem.from_uri(path)
    files.create_dir(name.rpartition("/")[0], recursive=True)
    attempt = TaskContext.get().taskAttemptId()
    with files.open_output_stream(f"{name}.{attempt}.zst", compression="zstd") as out:
        out.write(held.getvalue())
    files.move(f"{name}.{attempt}.zst", f"{name}.zst")


def _load(path: str) -> dict[str, np.ndarray]:
    files, name = pafs.FileSystem.from_uri(path)
    with files.open_input_stream(f"{name}.zst", compression="zstd") as f:
        return dict(np.load(io.BytesIO(f.read())))


# ---- bytes ---------------------------------------------------------------------


def _power(base: np.uint64, e: int) -> np.uint64:
    return np.uint64(pow(int(base), e, 1 << 64))


def _prefix_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``PREFIX`` bytes from each position, by doubling."""
    h, size, rest = text.astype(np.uint64) + np.uint64(1), 1, PREFIX
    found, length = None, 0
    while rest:
        if rest & 1:
            if found is None:
                found, length = h, size
            else:
                n = len(text) - length - size + 1
                found = found[:n] * _power(_BASE, size) + h[length : length + n]
                length += size
        rest >>= 1
        if rest:
            n = len(h) - size
            h = h[:n] * _power(_BASE, size) + h[size:]
            size *= 2
    return mix64(found)


def _hash_at(text: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, span: range, base: np.uint64) -> np.ndarray:
    """Hash of the bytes ``at + span``; those before ``low`` or from ``high`` on count as absent."""
    out = np.zeros(len(at), np.uint64)
    for i in range(0, len(at), 1 << 15):
        part = slice(i, i + (1 << 15))
        acc = np.zeros(len(at[part]), np.uint64)
        for k in span:
            p = at[part] + k
            there = (p >= low[part]) & (p < high[part])
            acc = acc * base + np.where(there, text[np.clip(p, 0, len(text) - 1)] + np.uint64(1), np.uint64(0))
        out[part] = mix64(acc)
    return out


def _word_hash(words: np.ndarray, at: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Hash of ``length`` bytes from ``at`` on, eight at a time; the last eight may overlap those before."""
    acc = np.full(len(at), base)
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        acc = (acc ^ words[at + k]) * base
        acc ^= acc >> np.uint64(32)
    return mix64(acc)


def _running(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    size, cur = 1, x
    while size * 2 <= width:
        cur = pick(cur[:-size], cur[size:])
        size *= 2
    n = len(x) - width + 1
    return pick(cur[:n], cur[width - size : width - size + n])


def sample_positions(text: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Positions whose prefix has the least hash among some ``SPAN`` neighbours; none of ``skip``."""
    found = []
    edge = SPAN - 1
    for start in range(0, len(text), _SLICE):
        low, high = max(0, start - edge), min(len(text), start + _SLICE + edge + PREFIX - 1)
        if high - low < PREFIX:
            continue
        h = _prefix_hashes(text[low:high])
        h[skip[low : low + len(h)]] = _TOP
        padded = np.concatenate([np.full(edge, _TOP), h, np.full(edge, _TOP)])
        greatest_least = _running(_running(padded, SPAN, np.minimum), SPAN, np.maximum)
        at = np.flatnonzero((greatest_least == h) & (h != _TOP)) + low
        found.append(at[(at >= start) & (at < start + _SLICE)])
    return np.concatenate(found) if found else np.empty(0, np.int64)


class Chunk:
    """Texts of some documents, one after another."""

    def __init__(self, path: str, text: np.ndarray, ids: np.ndarray, ends: np.ndarray, at: np.ndarray | None = None):
        self.path, self.text, self.ids, self.ends = path, text, ids, ends
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.at = sample_positions(text, self._skip()) if at is None else at.astype(np.int64)

    @classmethod
    def load(cls, path: str) -> Chunk:
        return cls(path, **_load(path))

    def save(self) -> None:
        _save(self.path, text=self.text, ids=self.ids, ends=self.ends, at=self.at.astype(np.int32))

    def _skip(self) -> np.ndarray:
        """Positions whose prefix leaves its document, and all of documents that take no part."""
        skip = np.zeros(len(self.text), bool)
        for start, end, doc in zip(self.starts, self.ends, self.ids):
            skip[start if doc == _NO_ID or end - start < WINDOW else max(start, end - PREFIX + 1) : end] = True
        return skip

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    @cached_property
    def words(self) -> np.ndarray:
        """The eight bytes from each position, as an integer."""
        w = np.concatenate([self.text, np.zeros(8, np.uint8)]).astype(np.uint64)
        for size in (1, 2, 4):
            w = w[:-size] | (w[size:] << np.uint64(8 * size))
        return w

    def prefixes(self, at: np.ndarray) -> np.ndarray:
        return _word_hash(self.words, at, PREFIX, _BASE) >> np.uint64(16)

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """Hash of the bytes around; those outside the document are told from any that are inside."""
        row = self.row(at)
        low, high = self.starts[row], self.ends[row]
        inside = (at - SPAN + 1 >= low) & (at + WINDOW <= high)
        out = np.empty(len(at), np.uint64)
        out[inside] = _word_hash(self.words, at[inside] - SPAN + 1, SPAN - 1 + WINDOW, _CONTEXT_BASE)
        cut = ~inside
        out[cut] = _hash_at(self.text, at[cut], low[cut], high[cut], range(1 - SPAN, WINDOW), _CONTEXT_BASE)
        return out


def _least_by_key(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ascending, the place of each row's key among them, the least value of each."""
    keys, place = np.unique(key, return_inverse=True)
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, place, value)
    return keys, place, least


def _by_bucket(keys: np.ndarray, width: int, bits: int) -> Iterator[tuple[int, slice]]:
    """Runs of ascending keys of ``width`` bits that share their leading ``bits``."""
    bucket = (keys >> np.uint64(width - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else []
    for a, b in zip(cuts, [*cuts[1:], len(keys)]):
        yield int(bucket[a]), slice(int(a), int(b))


# ---- the rounds, on the side of the chunks ---------------------------------------


def _first_round(chunk: Chunk, bits: int) -> list[Message]:
    key = chunk.prefixes(chunk.at)
    doc = chunk.ids[chunk.row(chunk.at)]
    keys, place, least = _least_by_key(key, doc)
    several = np.zeros(len(keys), np.uint8)
    several[place[doc != least[place]]] = 1
    chunk.save()
    rows: list[Message] = [(-1, chunk.path, b"")]
    for bucket, part in _by_bucket(keys, 48, bits):
        low, high = keys[part].astype(np.uint32), (keys[part] >> np.uint64(32)).astype(np.uint16)
        rows.append((bucket, chunk.path, _pack(low, high, several[part])))
    return rows


def _second_round(path: str, answers: list[tuple[int, bytes]], bits: int) -> list[Message]:
    chunk = Chunk.load(path)
    key = chunk.prefixes(chunk.at)
    keys = np.unique(key)
    repeated = np.zeros(len(keys), bool)
    told = dict(answers)
    for bucket, part in _by_bucket(keys, 48, bits):
        if bucket in told:
            repeated[part] = np.unpackbits(np.frombuffer(told[bucket], np.uint8), count=part.stop - part.start)
    used = repeated[np.searchsorted(keys, key)]
    at, key = chunk.at[used], key[used]
    context = chunk.contexts(at)
    doc = chunk.ids[chunk.row(at)]
    _save(f"{path}.contexts", at=at.astype(np.int32), key=key, context=context)
    rows: list[Message] = [(-1, path, b"")]
    contexts, _, least = _least_by_key(context, doc)
    for bucket, part in _by_bucket(contexts, 64, bits):
        rows.append((bucket, path, _pack(contexts[part], least[part])))
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    if len(keys):
        low, high = np.minimum.reduceat(context[order], first), np.maximum.reduceat(context[order], first)
        for bucket, part in _by_bucket(keys, 48, bits):
            rows.append(((1 << bits) + bucket, path, _pack(keys[part], low[part], high[part])))
    return rows


def _third_round(path: str, answers: list[tuple[int, bytes]], bits: int) -> list[Message]:
    chunk, held = Chunk.load(path), _load(f"{path}.contexts")
    at, key, context = held["at"].astype(np.int64), held["key"], held["context"]
    told = dict(answers)
    contexts, keys = np.unique(context), np.unique(key)
    least, several = np.full(len(contexts), np.iinfo(np.int64).max), np.zeros(len(keys), bool)
    for bucket, part in _by_bucket(contexts, 64, bits):
        (least[part],) = _unpack(told[bucket], "i8")
    for bucket, part in _by_bucket(keys, 48, bits):
        several[part] = np.unpackbits(np.frombuffer(told[(1 << bits) + bucket], np.uint8), count=part.stop - part.start)
    row = chunk.row(at)
    earliest = least[np.searchsorted(contexts, context)]
    repeats = chunk.ids[row] > earliest
    open_ = ~repeats & several[np.searchsorted(keys, key)]
    starts = _string_starts(chunk, at[repeats])
    asked = np.flatnonzero(_string_starts(chunk, at[open_]) & ~starts)
    _save(f"{path}.strings", starts=np.packbits(starts), asked=asked.astype(np.int32))
    strings, check, doc = _strings(chunk, asked)
    rows: list[Message] = [(-1, path, b"")]
    first, least = _distinct_strings(strings, check, doc)[1:]
    strings, check = strings[first], check[first]
    for bucket, part in _by_bucket(strings, 64, bits):
        rows.append((bucket, path, _pack(strings[part], check[part], least[part])))
    return rows


def _last_round(path: str, answers: list[tuple[int, bytes]], bits: int) -> pa.RecordBatch:
    chunk, held = Chunk.load(path), _load(f"{path}.strings")
    starts = np.unpackbits(held["starts"], count=len(chunk.text)).astype(bool)
    asked = held["asked"].astype(np.int64)
    strings, check, doc = _strings(chunk, asked)
    place, first, _ = _distinct_strings(strings, check, doc)
    least, told = np.full(len(first), np.iinfo(np.int64).max), dict(answers)
    for bucket, part in _by_bucket(strings[first], 64, bits):
        (least[part],) = _unpack(told[bucket], "i8")
    starts[asked[doc > least[place]]] = True
    change = np.zeros(len(chunk.text) + 1, np.int32)
    at = np.flatnonzero(starts)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    removed = np.cumsum(change[:-1]) > 0
    sizes, spans, digests = [], [], []
    for start, end in zip(chunk.starts, chunk.ends):
        gone = removed[start:end]
        sizes.append(int(gone.sum()))
        spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
        digests.append(hashlib.sha256(chunk.text[start:end][~gone].tobytes()).hexdigest())
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.ids == _NO_ID),
            "n_bytes": pa.array(chunk.ends - chunk.starts, pa.int64()),
            "n_removed": pa.array(sizes, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def _string_starts(chunk: Chunk, at: np.ndarray) -> np.ndarray:
    """Where the strings begin of which the sampled suffixes ``at`` can be the sample."""
    change = np.zeros(len(chunk.text) + 1, np.int32)
    row = chunk.row(at)
    low = np.maximum(at - SPAN + 1, chunk.starts[row])
    high = np.minimum(at, chunk.ends[row] - WINDOW) + 1
    some = low < high
    np.add.at(change, low[some], 1)
    np.add.at(change, high[some], -1)
    return np.cumsum(change[:-1]) > 0


def _strings(chunk: Chunk, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """96 bits of hash of the strings at ``at``, and their documents."""
    one = _word_hash(chunk.words, at, WINDOW, _STRING_BASE)
    two = _word_hash(chunk.words, at, WINDOW, _CONTEXT_BASE) >> np.uint64(32)
    return one, two.astype(np.uint32), chunk.ids[chunk.row(at)]


def _distinct_strings(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the place of its string, then one row of each string in order, and its least document."""
    order = np.lexsort((doc, two, one))
    a, b = one[order], two[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.empty(0, bool)
    place = np.empty(len(one), np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    return place, first, doc[first]


# ---- the rounds, on the side of the keys -------------------------------------------


def _shared_prefixes(asked: list[tuple[str, bytes]], bits: int, bucket: int) -> Iterator[tuple[str, bytes]]:
    parts = [_unpack(p, "u4", "u2", "u1") for _, p in asked]
    keys = [low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)) for low, high, _ in parts]
    all_keys = np.concatenate(keys)
    distinct, place, times = np.unique(all_keys, return_inverse=True, return_counts=True)
    shared = times > 1
    shared[place[np.concatenate([several for _, _, several in parts]) > 0]] = True
    ends = np.cumsum([len(k) for k in keys])
    for (chunk, _), mask in zip(asked, np.split(shared[place], ends[:-1])):
        if mask.any():
            yield chunk, np.packbits(mask).tobytes()


def _contexts(asked: list[tuple[str, bytes]], bits: int, bucket: int) -> Iterator[tuple[str, bytes]]:
    if bucket < 1 << bits:
        parts = [_unpack(p, "u8", "i8") for _, p in asked]
        _, place, least = _least_by_key(np.concatenate([k for k, _ in parts]), np.concatenate([d for _, d in parts]))
        ends = np.cumsum([len(k) for k, _ in parts])
        for (chunk, _), found in zip(asked, np.split(least[place], ends[:-1])):
            yield chunk, _pack(found)
        return
    parts = [_unpack(p, "u8", "u8", "u8") for _, p in asked]
    keys, place = np.unique(np.concatenate([k for k, _, _ in parts]), return_inverse=True)
    low, high = np.full(len(keys), _TOP), np.zeros(len(keys), np.uint64)
    np.minimum.at(low, place, np.concatenate([x for _, x, _ in parts]))
    np.maximum.at(high, place, np.concatenate([x for _, _, x in parts]))
    ends = np.cumsum([len(k) for k, _, _ in parts])
    for (chunk, _), mask in zip(asked, np.split((low != high)[place], ends[:-1])):
        yield chunk, np.packbits(mask).tobytes()


def _least_documents(asked: list[tuple[str, bytes]], bits: int, bucket: int) -> Iterator[tuple[str, bytes]]:
    parts = [_unpack(p, "u8", "u4", "i8") for _, p in asked]
    one, two, doc = (np.concatenate(x) for x in zip(*parts))
    place, _, least = _distinct_strings(one, two, doc)
    ends = np.cumsum([len(k) for k, _, _ in parts])
    for (chunk, _), found in zip(asked, np.split(least[place], ends[:-1])):
        yield chunk, _pack(found)


# ---- Spark ---------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Message]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _answer(messages: DataFrame, reduce: Callable, bits: int, parts: int) -> DataFrame:
    """Tuples to the tasks of their keys, one bucket at a time, and what these answer."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_rows(batches), key=lambda r: r[0]):
            if bucket < 0:
                for _, chunk, payload in rows:
                    yield _messages([(bucket, chunk, payload)])
                continue
            asked = [(chunk, payload) for _, chunk, payload in rows]
            yield _messages([(bucket, chunk, payload) for chunk, payload in reduce(asked, bits, bucket)])

    # Chunks announce themselves by bucket -1; they are spread by their name.
    place = F.when(F.col("bucket") < 0, F.xxhash64("chunk")).otherwise(F.col("bucket"))
    spread = messages.repartition(parts, place)
    return spread.sortWithinPartitions("bucket", "chunk").mapInArrow(task, _MESSAGE)


def _to_chunks(answers: DataFrame, step: Callable, schema: str, bits: int, parts: int) -> DataFrame:
    """Answers to the tasks of their chunks, and what these make of each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, rows in groupby(_rows(batches), key=lambda r: r[1]):
            made = step(path, [(bucket, payload) for bucket, _, payload in rows if bucket >= 0], bits)
            yield made if isinstance(made, pa.RecordBatch) else _messages(made)

    return answers.repartition(parts, "chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(task, schema)


def _write_chunks(docs: DataFrame, folder: str, bits: int, chunk_bytes: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, n = TaskContext.get().partitionId(), 0
        texts: list[bytes] = []
        ids: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            text = np.frombuffer(b"".join(texts), np.uint8)
            ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
            chunk = Chunk(f"{folder}/{partition:06d}-{n:04d}", text, np.array(ids, np.int64), ends)
            return _messages(_first_round(chunk, bits))

        for batch in batches:
            for doc, text in zip(batch.column(0).fill_null(_NO_ID).to_pylist(), as_bytes(batch.column(1))):
                ids.append(doc)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= chunk_bytes:
                    yield flush()
                    texts, ids, held, n = [], [], 0, n + 1
        if ids:
            yield flush()

    return docs.mapInArrow(task, _MESSAGE)


def remove_repeats(
    work: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A text is its UTF-8 bytes; null is empty. A byte goes if some 50-byte string
    over it, within the document, also starts in a document with a smaller id;
    strings are judged on the input. ``n_spans`` counts maximal runs of removed
    bytes, ``kept_sha256`` is of the others, joined. Rows that repeat an id are no
    reason for one another to lose anything. Rows without an id lose nothing and are
    no reason for others. Texts below 50 bytes stay. No rows give none.

    Prefixes and contexts are told apart by 48 and 64 bits of hash, of which the
    first only saves work, strings by 96. A context or string is wrongly taken
    for another with a probability of about 2e-5 in a corpus of 25 million
    contexts, 5e-12 for as many strings.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (2 * parts - 1).bit_length())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    answers = work.cut(_answer(_write_chunks(rows, f"{work.path}/chunks", bits, chunk_bytes), _shared_prefixes, bits, parts))
    asked = _to_chunks(answers, _second_round, _MESSAGE, bits, parts)
    answers = work.cut(_answer(asked, _contexts, bits, parts))
    asked = _to_chunks(answers, _third_round, _MESSAGE, bits, parts)
    answers = work.cut(_answer(asked, _least_documents, bits, parts))
    return work.result(_to_chunks(answers, _last_round, _RESULT, bits, parts))
