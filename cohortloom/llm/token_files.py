"""Token-id files: ids packed at the fewest bits of the vocabulary, in blocks with offsets.

A shard file holds, all little-endian:

* 8 bytes ``IDPACK01``; uint32 bits per id, uint32 ids per block; uint64 number
  of ids, uint64 number of documents;
* uint64 offsets of the blocks from the start of the payload, one more than blocks;
* int64 ids of the documents; uint64 first token of each, one more than documents;
* the payload. Id ``i`` of a block takes bits ``i * bits`` onwards, lowest bit
  first. Blocks begin at whole bytes, so any one can be read and unpacked by
  itself, in one vectorised step.

Files are written to a temporary name and then moved, under names that depend on
the partition only, so a task that runs again replaces its own files.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm.words import as_bytes
from cohortloom.llm.workspace import Workspace, delete_path
from cohortloom.session import ship_package

MAGIC = b"IDPACK01"
NULL_ID = -(2**63)
BLOCK_IDS = 8192
SHARD_IDS = 1 << 23
_SLICE_BYTES = 1_000_000
_CACHE_BYTES = 16_000_000
_JOINED = 500
_MARKS = "!#$%&*+,-./:;=?@^_|~"
_MANIFEST = "path string, partition int, shard int, n_ids long, n_docs long"


def id_bits(vocabulary_size: int) -> int:
    """The fewest bits that hold every id."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of one block as bits."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    powers = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (planes.reshape(n, bits) * powers).sum(axis=1, dtype=np.uint32)


class Shard(NamedTuple):
    """The index of a shard file, from which any block can be read."""

    file: pa.NativeFile
    bits: int
    block_ids: int
    n_ids: int
    offsets: np.ndarray
    doc_ids: np.ndarray
    starts: np.ndarray
    payload: int

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` up to ``last``; only the blocks that hold them are read."""
        if first >= last:
            return np.empty(0, np.uint32)
        low, high = first // self.block_ids, (last - 1) // self.block_ids + 1
        data = self.file.read_at(int(self.offsets[high] - self.offsets[low]), self.payload + int(self.offsets[low]))
        parts = []
        for b in range(low, high):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            at = slice(int(self.offsets[b] - self.offsets[low]), int(self.offsets[b + 1] - self.offsets[low]))
            parts.append(unpack(memoryview(data)[at], self.bits, n))
        return np.concatenate(parts)[first - low * self.block_ids : last - low * self.block_ids]


def open_shard(path: str) -> Shard:
    files, name = pafs.FileSystem.from_uri(path)
    f = files.open_input_file(name)
    head = f.read_at(32, 0)
    if head[:8] != MAGIC:
        raise ValueError(f"not a token file: {path}")
    bits, block_ids = np.frombuffer(head, "<u4", 2, 8)
    n_ids, n_docs = (int(x) for x in np.frombuffer(head, "<u8", 2, 16))
    n_blocks = -(-n_ids // int(block_ids))
    index = f.read_at(8 * (n_blocks + 1 + n_docs + n_docs + 1), 32)
    offsets = np.frombuffer(index, "<u8", n_blocks + 1)
    doc_ids = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1))
    starts = np.frombuffer(index, "<u8", n_docs + 1, 8 * (n_blocks + 1 + n_docs)).astype(np.int64)
    return Shard(f, int(bits), int(block_ids), n_ids, offsets.astype(np.int64), doc_ids, starts, 32 + len(index))


def write_shard(path: str, ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, bits: int) -> None:
    blocks = [pack(ids[i : i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    files, name = pafs.FileSystem.from_uri(path)
    folder, _, last = name.rpartition("/")
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(MAGIC)
        out.write(np.array([bits, BLOCK_IDS], "<u4").tobytes())
        out.write(np.array([len(ids), len(doc_ids)], "<u8").tobytes())
        out.write(np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes())
        out.write(doc_ids.astype("<i8").tobytes())
        out.write(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
        for b in blocks:
            out.write(b)
    files.move(draft, name)


class WordEncoder(dict):
    """Ids of texts by a tokenizer that never joins what white space parts.

    ``self`` maps a word, as UTF-8, to its place in ``starts``; the ids of all
    words lie in one pool, from which those of a text are gathered in one step.
    Only words not met before go through the tokenizer, many at a time.
    ``is_splittable`` says whether a tokenizer allows this; others encode whole texts.
    """

    def __init__(self, path: str):
        # A task has one core; the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = id_bits(self.tokenizer.get_vocab_size())
        self.splittable = is_splittable(self.tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.word_ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.word_ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.held = 0
        self.pool = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        self.held += len(word) + 10
        return code

    def _encode_parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of strings without white space.

        Strings of letters are each one word to the tokenizer, whose last id has
        the mark of a word's end: many go through it at once and are told apart by
        that. Other strings are told apart by the offsets of their ids, and those
        whose length changes as they are normalised are encoded one by one.
        """
        found: list[list[int]] = [[]] * len(parts)
        kinds: tuple[list[int], ...] = ([], [], [])
        marked = bool(self.word_ends.any())
        for i, p in enumerate(parts):
            steady = p.isascii() or not _changes_length(p)
            kinds[2 if not steady else 0 if marked and p.isalpha() and p.lower().isalpha() else 1].append(i)
        for i in kinds[2]:
            found[i] = self.tokenizer.encode(parts[i], add_special_tokens=False).ids
        for kind, tell_apart in ((kinds[0], self._by_word_ends), (kinds[1], self._by_offsets)):
            for k in range(0, len(kind), _JOINED):
                places = kind[k : k + _JOINED]
                for i, ids in zip(places, tell_apart([parts[i] for i in places])):
                    found[i] = ids
        return found

    def _by_word_ends(self, words: list[str]) -> list[list[int]]:
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        cuts = (np.flatnonzero(self.word_ends[ids]) + 1).tolist()
        if len(cuts) != len(words):
            return self._by_offsets(words)
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def _by_offsets(self, parts: list[str]) -> list[list[int]]:
        encoding = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = encoding.ids
        firsts = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(ids))
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        cuts = np.searchsorted(firsts, np.cumsum(lengths + 1)[:-1]).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]

    def _learn(self) -> None:
        parts: dict[str, int] = {}
        cut = [_letters_and_marks(w.decode()) for w in self.new]
        places = [[parts.setdefault(p, len(parts)) for p in ps] for ps in cut]
        ids = self._encode_parts(list(parts))
        found = [ids[ps[0]] if len(ps) == 1 else ids[ps[0]] + ids[ps[1]] for ps in places]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        total = int(lengths.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += total
        self.new = []

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each has."""
        if not self.splittable:
            whole = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            n = np.fromiter((len(e.ids) for e in whole), np.int64, len(whole))
            return np.fromiter(chain.from_iterable(e.ids for e in whole), np.uint32, int(n.sum())), n
        if self.held > _CACHE_BYTES:
            self.forget()
        # A-Z in lower case finds more words again; the marks of special tokens must stay as they are.
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        words = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(words.sum()))
        if self.new:
            self._learn()
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        total = np.concatenate([[0], ends])
        last = np.cumsum(words)
        return ids, total[last] - total[last - words]


def _changes_length(text: str) -> bool:
    return not unicodedata.is_normalized("NFC", text) or len(text.lower()) != len(text)


def _letters_and_marks(word: str) -> tuple[str, ...]:
    """A word and the punctuation after it, which is always a token of its own after a letter."""
    letters = word.rstrip(_MARKS)
    if 0 < len(letters) < len(word) and letters[-1].lower().isalpha():
        return letters, word[len(letters) :]
    return (word,)


def is_splittable(tokenizer: object) -> bool:
    """Whether the ids of a text are those of its parts between ASCII white space.

    True of tokenizers that make any white space one space, lower-case by
    character, and drop white space between the words they find.
    """
    import json

    spec = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    words = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and spec["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and (words.get("type"), words.get("behavior"), words.get("invert")) == ("Split", "Removed", True)
        and r"[^\s\p{L}\p{N}]+" in words.get("pattern", {}).get("Regex", "")
        and not any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    )


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _slices(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of about ``_SLICE_BYTES``."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= _SLICE_BYTES:
            yield slice(first, i + 1)
            first, held = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def write_token_files(
    work: Workspace,
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Encode ``docs`` in ascending id order into shard files; returns their manifest.

    Each document is the ids of its whole text (null: empty) without special
    tokens, then ``end_id``. Texts are range-partitioned by (id, hash of text),
    so that repeated ids do not pile up, and sorted: null ids first, rows of one
    id by their text. A shard ends when it has ``shard_ids`` ids, at the end of
    a document. The manifest (one row per shard: ``path, partition, shard, n_ids, n_docs``)
    is written beside the files; no documents give an empty one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = f"{work.kept}/files"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        partition = TaskContext.get().partitionId()
        ids, doc_ids, lengths, held, shard = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/part-{partition:06d}-{shard:04d}.ids"
            n = np.concatenate(lengths)
            write_shard(path, np.concatenate(ids), np.concatenate(doc_ids), n, encoder.bits)
            return pa.RecordBatch.from_pydict(
                {
                    "path": [path],
                    "partition": pa.array([partition], pa.int32()),
                    "shard": pa.array([shard], pa.int32()),
                    "n_ids": pa.array([held], pa.int64()),
                    "n_docs": pa.array([len(n)], pa.int64()),
                }
            )

        for batch in batches:
            keys = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            texts = as_bytes(batch.column(1).fill_null(""))
            for part in _slices(texts):
                found, n = encoder.encode(texts[part])
                ids.append(np.insert(found, np.cumsum(n), end_id).astype(np.uint16 if encoder.bits <= 16 else np.uint32))
                doc_ids.append(keys[part])
                lengths.append(n + 1)
                held += len(ids[-1])
                if held >= shard_ids:
                    yield flush()
                    ids, doc_ids, lengths, held, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield flush()

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie", "text")
        .select("id", "text")
    )
    return work.result(ordered.mapInArrow(task, _MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: ``id_col, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all shards and documents before it. The running
    sum of shard sizes is over one row per file; each shard is read by one task.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = open_shard(path)
                ids = shard.ids(0, shard.n_ids).astype("<u4")
                starts = shard.starts
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: pa.array(shard.doc_ids, pa.int64(), mask=shard.doc_ids == NULL_ID),
                        "start": pa.array(before + starts[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(starts), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    before = W.orderBy("partition", "shard").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    shards = max(1, manifest.count())
    return placed.repartition(shards, "path").mapInArrow(
        task, f"{id_col} long, start long, n_tokens long, ids_crc32 long"
    )


def drop_files(manifest: DataFrame, work: Workspace) -> None:
    """Delete the files of ``write_token_files``."""
    delete_path(manifest.sparkSession, work.kept)
