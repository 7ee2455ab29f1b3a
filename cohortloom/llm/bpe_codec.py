"""Byte-level BPE encoding and decoding: speculate with the longest match, verify pairs, merge what fails.

1. A text is split into words by the tokenizer's pattern; each word is encoded once per task.
2. *Speculate*: the words not met before lie end to end in one byte array. A walk down
   the trie of the vocabulary from all their bytes at once gives the longest token that
   starts at each; a word's proposal is the chain of these from its first byte on.
3. *Verify*: a row of tokens is what the merges make of a word if each adjacent pair is
   what they make of the pair's bytes. For a pair that is decided by undoing the merges of
   both tokens from the last to the first: it fails if tokens that meet at the border
   would have been merged before either was merged away from it. All distinct
   pairs of all words are tested together.
4. Words with a failing pair are merged exactly, one merge after another.

The pair test holds for vocabularies in which each token has one merge, made
after those of its parts; others are merged exactly throughout.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.words import as_bytes
from cohortloom.session import ship_package

#: Fixed value: how a byte-level tokenizer parts a text into words.
WORD_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"
_NEVER = np.int64(1) << 60
#: What ends a word in the byte array: no byte, so no token goes on over it.
_END = 256
#: Texts are encoded in slices of about so many characters, and longer ones in parts of it.
_SLICE = 1 << 20
#: Words of more bytes are merged one by one.
_LONG_WORD = 200
_CACHE_BYTES = 24_000_000
_BORDER = regex.compile(r"\S(?= )")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it is printable, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Merges:
    """The vocabulary of a tokenizer file as arrays over token ids, and the three steps over bytes."""

    def __init__(self, vocab: dict[str, int], merges: list):
        letters = {c: b for b, c in enumerate(byte_letters())}
        size = max(vocab.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for text, i in vocab.items():
            if all(c in letters for c in text):
                self.tokens[i] = bytes(letters[c] for c in text)
        self.byte_ids = [vocab.get(c) for c in byte_letters()]
        if None in self.byte_ids:
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.merged = {
            (vocab[x], vocab[y]): (rank, vocab[x + y]) for rank, (x, y) in reversed(list(enumerate(pairs)))
        }
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for (x, y), (rank, made) in self.merged.items():
            self.rank[made], self.left[made], self.right[made] = rank, x, y
        ranks = np.array([rank for rank, _ in self.merged.values()], np.int64)
        keys = np.array([x * size + y for x, y in self.merged], np.int64)
        order = np.argsort(keys)
        self._pairs, self._pair_ranks, self._size = keys[order], ranks[order], size
        self._made = np.zeros(len(pairs), np.int64)
        self._made[ranks] = [made for _, made in self.merged.values()]
        self._byte_ids = np.array(self.byte_ids, np.int64)
        made = self.rank >= 0
        parts_first = (self.rank[self.left] < self.rank) & (self.rank[self.right] < self.rank)
        self.has_pair_test = int(made.sum()) == len(self.merged) and bool(parts_first[made].all())
        self._grow_trie(made)

    def _grow_trie(self, made: np.ndarray) -> None:
        """Trie of the tokens that the merges make of their own bytes."""
        own = made.copy()
        own[made] = ~self.failing(self.left[made], self.right[made], self.rank[made])
        for b in self.byte_ids:
            own[b] = True
        whole = own.copy()
        for i in np.argsort(self.rank, kind="stable"):
            if self.rank[i] >= 0:
                whole[i] &= whole[self.left[i]] & whole[self.right[i]]
        children: dict[int, int] = {}
        accepts = [-1]
        for i in np.flatnonzero(whole):
            node = 0
            for b in self.tokens[i]:
                key = node * (_END + 1) + b
                if key not in children:
                    children[key] = len(accepts)
                    accepts.append(-1)
                node = children[key]
            accepts[node] = int(i)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(keys)
        self._edges = keys[order]
        self._child = np.fromiter(children.values(), np.int64, len(children))[order]
        self._accepts = np.array(accepts, np.int64)

    def _pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        keys = x * self._size + y
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._pair_ranks[at], _NEVER)

    def failing(self, x: np.ndarray, y: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Which pairs of tokens are not what the merges, up to rank ``until``, make of their bytes.

        Of equal merges the one further left comes first, so one across the border
        loses to that of the left token, and wins over that of the right one.
        """
        bad = np.zeros(len(x), bool)
        live = np.arange(len(x))
        end_x = np.full(len(x), _NEVER) if until is None else until
        end_y = end_x
        while len(live):
            across = self._pair_rank(x, y)
            fails = (across < end_x) & (across <= end_y)
            bad[live[fails]] = True
            undo_x = self.rank[x] > self.rank[y]
            go = ~fails & (undo_x | (self.rank[y] >= 0))
            live, x, y, end_x, end_y, undo_x = (a[go] for a in (live, x, y, end_x, end_y, undo_x))
            end_x, end_y = np.where(undo_x, self.rank[x], end_x), np.where(undo_x, end_y, self.rank[y])
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return bad

    def longest(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``data`` the longest token that starts there, and its bytes."""
        token, length = np.full(len(data), -1, np.int64), np.ones(len(data), np.int64)
        at = np.flatnonzero(data != _END)
        node, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            keys = node * (_END + 1) + data[at + depth]
            edge = np.minimum(np.searchsorted(self._edges, keys), len(self._edges) - 1)
            goes = self._edges[edge] == keys
            at, node, depth = at[goes], self._child[edge[goes]], depth + 1
            found = self._accepts[node] >= 0
            token[at[found]], length[at[found]] = self._accepts[node[found]], depth
        return token, length

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, end to end, and their number for each."""
        if not self.has_pair_test:
            return self.merge_words(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        data = np.full(ends[-1] if len(ends) else 0, _END, np.int64)
        inside = np.ones(len(data), bool)
        inside[ends - 1] = False
        data[inside] = np.frombuffer(b"".join(words), np.uint8)
        token, length = self.longest(data)
        steps, chain, counts, start = length.tolist(), [], [], 0
        for end in (ends - 1).tolist():
            before = len(chain)
            while start < end:
                chain.append(start)
                start += steps[start]
            counts.append(len(chain) - before)
            start = end + 1
        ids, n = token[np.array(chain, np.int64)], np.array(counts, np.int64)
        word = np.repeat(np.arange(len(words)), n)
        same = word[:-1] == word[1:]
        pairs, which = np.unique((ids[:-1] * self._size + ids[1:])[same], return_inverse=True)
        bad = np.unique(word[:-1][same][self.failing(pairs // self._size, pairs % self._size)[which]])
        merged, merged_n = self.merge_words([words[i] for i in bad.tolist()])
        starts = np.cumsum(n) - n
        starts[bad], n[bad] = len(ids) + np.cumsum(merged_n) - merged_n, merged_n
        return _gather(np.concatenate([ids, merged]), starts, n), n

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact ids of all words, end to end, and their number for each.

        Each round makes the next merge of every word: the lowest rank, of equal ones
        the leftmost. Long words, of which few have many rounds, are merged by themselves.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        is_long = lengths > _LONG_WORD
        owner = np.repeat(np.flatnonzero(~is_long), lengths[~is_long])
        ids = self._byte_ids[np.frombuffer(b"".join(w for w in words if len(w) <= _LONG_WORD), np.uint8)]
        none, done = len(self._made), []

        def ranks_at(i: np.ndarray) -> np.ndarray:
            j = np.minimum(i + 1, len(ids) - 1)
            inside = (i >= 0) & (i < j) & (owner[i] == owner[j])
            return np.where(inside, np.minimum(self._pair_rank(ids[i], ids[j]), none), none)

        ranks = ranks_at(np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(ranks * len(ids) + np.arange(len(ids)), first)
            over = low // len(ids) == none
            at, rank = low[~over] % len(ids), low[~over] // len(ids)
            ends = np.repeat(over, np.diff(np.append(first, len(ids))))
            done.append((owner[ends], ids[ends]))
            ids[at] = self._made[rank]
            stays, touched = ~ends, np.zeros(len(ids), bool)
            stays[at + 1], touched[at] = False, True
            ids, owner, ranks, touched = ids[stays], owner[stays], ranks[stays], touched[stays]
            at = np.flatnonzero(touched)
            ranks[at] = ranks_at(at)
            before = at[at > 0] - 1
            ranks[before] = ranks_at(before)
        done += [(np.full(len(m), i), m) for i in np.flatnonzero(is_long) for m in (self.merge(words[i]),)]
        owner, ids = (np.concatenate([np.empty(0, np.int64), *side]) for side in zip(*done)) if done else (owner, ids)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def merge(self, word: bytes) -> np.ndarray:
        """Exact ids of one word, by a queue of the merges that are possible."""
        ids = [self.byte_ids[b] for b in word]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        waiting = [
            (self.merged[pair][0], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in self.merged
        ]
        heapify(waiting)
        while waiting:
            _, i, x, y = heappop(waiting)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = self.merged[x, y][1], -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (pair := (ids[a], ids[b])) in self.merged:
                    heappush(waiting, (self.merged[pair][0], a, *pair))
        return np.array([i for i in ids if i >= 0], np.int64)


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` from ``starts`` on, end to end."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class _Words(dict):
    """Number of each word met; new ones are noted in ``fresh``. An integer is a special token's id."""

    def __init__(self) -> None:
        self.fresh: list[str | int] = []

    def __missing__(self, word: str | int) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class BpeCodec:
    """Encoder and decoder of a byte-level tokenizer file; special tokens in a text are their ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        if not plain or spec["normalizer"] or model["type"] != "BPE" or model["dropout"] or model["ignore_merges"]:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.merges = Merges(model["vocab"], model["merges"])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_length = sorted(self.specials, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self._words = regex.compile(WORD_PATTERN)
        self._split_as_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._usual: set[str] = set(map(chr, range(128)))
        self._odd: set[str] = set()
        spelled = [t or b"" for t in self.merges.tokens]
        spelled += [b""] * (max(self.specials.values(), default=0) + 1 - len(spelled))
        for content, i in self.specials.items():
            spelled[i] = content.encode()
        self._lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self._cache, self._held = _Words(), 0
        self._ids = self._n = self._first = np.empty(0, np.int64)

    def _split(self, text: str) -> list[str]:
        """Words of a text without special tokens.

        Letters and digits are those of the library's edition of Unicode: a text with a
        character that it takes otherwise than the pattern does here is split by the library.
        """
        if not text.isascii():
            met = set(text)
            for c in met - self._usual - self._odd:
                probe = f"a{c}1{c}!{c} {c}{c}a"
                same = [probe[a:b] for _, (a, b) in self._split_as_library(probe)] == self._words.findall(probe)
                (self._usual if same else self._odd).add(c)
            if met & self._odd:
                return [text[a:b] for _, (a, b) in self._split_as_library(text)]
        return self._words.findall(text)

    def _parts(self, text: str) -> Iterator[str | int]:
        """Stretches of a text, and ids of the special tokens between them.

        A stretch of over ``_SLICE`` characters ends where a space follows
        something else, which is the border of two words in any text.
        """
        start = 0
        for hit in (*(self._special.finditer(text) if self._special else ()), None):
            end = hit.start() if hit else len(text)
            while end - start > _SLICE and (border := _BORDER.search(text, start + _SLICE, end)):
                yield text[start : border.end()]
                start = border.end()
            if end > start:
                yield text[start:end]
            if hit:
                yield self.specials[hit.group()]
                start = hit.end()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and their number for each."""
        found, counts = [], np.zeros(len(texts), np.int64)
        words, owners, held = [], [], 0

        def take() -> None:
            ids, n = self._look_up(words)
            upto = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *(k for _, k in owners)])]
            np.add.at(counts, [i for i, _ in owners], np.diff(upto))
            found.append(ids)

        for i, text in enumerate(texts):
            for part in self._parts(text):
                own = [part] if isinstance(part, int) else self._split(part)
                words += own
                owners.append((i, len(own)))
                held += 1 if isinstance(part, int) else len(part)
                if held >= _SLICE:
                    take()
                    words, owners, held = [], [], 0
        if owners:
            take()
        return np.concatenate([np.empty(0, np.int64), *found]), counts

    def _look_up(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, end to end, and their number for each; new ones are encoded together."""
        if self._held > _CACHE_BYTES:
            self._forget()
        numbers = np.fromiter(map(self._cache.__getitem__, words), np.int64, len(words))
        if fresh := self._cache.fresh:
            coded = [b"" if isinstance(w, int) else w.encode() for w in fresh]
            ids, n = self.merges.encode_words(coded)
            special = [k for k, w in enumerate(fresh) if isinstance(w, int)]
            if special:
                ids = np.insert(ids, np.cumsum(n)[special], [fresh[k] for k in special])
                n[special] = 1
            self._ids, self._n = np.concatenate([self._ids, ids]), np.concatenate([self._n, n])
            self._first = np.cumsum(self._n) - self._n
            self._held += sum(map(len, coded)) + 150 * len(fresh)
            self._cache.fresh = []
        return _gather(self._ids, self._first[numbers], self._n[numbers]), self._n[numbers]

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """Texts of stretches of ids, special tokens included; bytes that are no UTF-8 are U+FFFD."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._lengths)):
            raise ValueError("ids outside of the vocabulary")
        lengths = self._lengths[ids]
        data = _gather(self._bytes, self._starts[ids], lengths).tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:])]


@lru_cache(maxsize=2)
def _codec(path: str) -> BpeCodec:
    return BpeCodec(path)


def _runs(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive rows that hold about ``most`` together."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` of each row: the ids of its whole text, as an array; a null text is empty.

    ``path`` is a byte-level tokenizer file, at the same place on all nodes. No special
    tokens are added; their strings in a text become their ids. Rows are encoded where they
    are, without a shuffle, so repeated ids and null ids are rows like others, and
    no rows give none. Other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            coded = as_bytes(batch.column(1).fill_null(""))
            for part in _runs([len(c) for c in coded], 2 * _SLICE):
                ids, n = codec.encode([c.decode("utf-8", "replace") for c in coded[part]])
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], lists], [id_col, "ids"])

    return rows.mapInArrow(task, f"{id_col} long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, text`` of each row: the text its ids spell, special tokens included.

    Null ids spell the empty text; an id that the vocabulary does not have is an error.
    """
    ship_package(encoded.sparkSession)
    rows = encoded.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            lists = batch.column(1)
            for part in _runs(lists.value_lengths().to_pylist(), 2 * _SLICE):
                some = lists[part]
                flat, n = some.flatten().to_numpy(), some.value_lengths().to_numpy()
                texts = pa.array(codec.decode(flat.astype(np.int64), n), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], some, texts], [id_col, "ids", "text"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(task, f"`{id_col}` {kind}, ids array<int>, text string")
