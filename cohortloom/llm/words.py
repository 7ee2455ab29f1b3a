"""Words and word shingles as 64-bit hashes, for tasks that run Python."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE = 5
_CACHE_BYTES = 24_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class HashedWords(dict):
    """64-bit hash of each word met, kept until the words take ``_CACHE_BYTES``."""

    def __init__(self, hash_word: Callable[[bytes | str], int] = xxhash.xxh64_intdigest):
        self.hash_word = hash_word
        self.held = 0

    def __missing__(self, word: bytes | str) -> int:
        value = self.hash_word(word)
        if len(word) < 100:
            self[word] = value
            self.held += len(word) + 100
        return value

    def of(self, words: list) -> np.ndarray:
        """Hashes of a text's words; the cache is emptied between texts when it is full."""
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if self.held > _CACHE_BYTES:
            self.clear()
            self.held = 0
        return hashes


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers over all positions (a public finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: what bytes do by themselves."""
    return text.lower().split()


def shingle_hashes(text: bytes | None, words: HashedWords) -> np.ndarray:
    """Hashes of a text's shingles in text order; one of the whole sequence if it is shorter."""
    h = words.of(ascii_words(text)) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    width = min(SHINGLE, len(h))
    mixed = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        mixed = (mixed + h[i : len(h) - width + 1 + i]) * _GOLDEN
    return mix64(mixed + np.uint64(SHINGLE - width))


def shingle_set(text: bytes | None, words: HashedWords) -> np.ndarray:
    """The distinct shingles, ascending."""
    return np.unique(shingle_hashes(text, words))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8, without decoding it."""
    return column.cast(pa.large_binary()).to_pylist()
