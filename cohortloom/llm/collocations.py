"""Phrase collocations by prefix-free parsing: count n-grams in a dictionary of chunks.

1. *Parse*: a text is a row of words and breaks. Wherever the hash of the next
   ``OVERLAP`` of these hits a trigger, a chunk ends behind them and the next starts with them, so
   equal passages give equal chunks wherever they stand. A break pads the end of a text.
   Chunks are counted in the task, then by a shuffle: a dictionary with parse frequencies.
2. *Count*: an n-gram belongs to the chunk in which it starts before the last ``OVERLAP`` words,
   which is one chunk, and lies in it whole. So n-grams are counted inside
   distinct chunks, each weighted by its frequency.
3. Words and pairs are counted first, in one pass over the dictionary. A longer phrase can be
   frequent only if all its pairs are; a bitmap of fixed size over the hashes of the frequent ones lets
   the second pass go over the others. It only saves work: what it lets through is counted exactly, by text.
4. Every cut of a frequent phrase into two is scored; both parts are frequent as well, so their
   counts are at hand.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm.words import HashedWords, as_bytes, mix64
from cohortloom.llm.workspace import Workspace
from cohortloom.operators.joins import lookup_join
from cohortloom.session import ship_package

MAX_WORDS = 5
#: Words two chunks share: what the longest phrase needs beyond its first word.
OVERLAP = MAX_WORDS - 1
#: One window in so many ends a chunk; without any for ``_LONGEST`` words, one is cut there.
_TRIGGER = np.uint64(16)
_LONGEST = 512
#: Characters between pieces, between words, and what stands for a break (no byte of UTF-8).
_BREAKS, _BLANKS, _BREAK = b".,;:!?\n\x0b\x0c\r", b"\t", b"\xff"
_PLAIN = bytes.maketrans(_BREAKS + _BLANKS, _BREAK * len(_BREAKS) + b" ")
#: How a break is written in a chunk: no word has one.
_WRITTEN = b"\n"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the bitmap of frequent phrases: 8 MB, however many there are.
FILTER_BITS = 26
#: Tokens counted at once, and bytes of chunks held, in a task.
_TOKENS = 1_500_000
_HELD_BYTES = 64_000_000
#: Parts of a language's candidates that are ranked before their best ones are ranked together.
_RANK_PARTS = 128
#: Shares over which a language's cuts are dealt to meet its number of words.
_SHARES = 64
_COUNTS = "lang string, phrase string, size int, n long"


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased, and breaks; ``OVERLAP`` breaks at its end. Without words none."""
    found = text.lower().translate(_PLAIN).replace(_BREAK, b" \xff ").split()
    return [*found, *[_BREAK] * OVERLAP] if found else found


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive elements."""
    n = max(0, len(hashes) - size + 1)
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed + hashes[i : n + i]) * _GOLDEN
    return mix64(mixed)


def chunk_starts(hashes: np.ndarray) -> np.ndarray:
    """Where the chunks of a row of tokens start, and where its last words end."""
    hits = np.flatnonzero(windows(hashes, OVERLAP) % _TRIGGER == 0)
    end = len(hashes) - OVERLAP
    starts = np.unique(np.concatenate([[0], hits[hits < end], [end]]))
    gaps = np.diff(starts)
    if (gaps > _LONGEST).any():
        more = [np.arange(a, b, _LONGEST) for a, b in zip(starts, starts[1:])]
        starts = np.concatenate([*more, [end]])
    return starts


def parse(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, chunk, n``: the distinct chunks of all texts of a language and their frequencies."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, held = HashedWords(), Counter(), 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _ in counts], pa.string()),
                    pa.array([chunk.replace(_BREAK, _WRITTEN) for _, chunk in counts], pa.binary()).cast(pa.string()),
                    pa.array(counts.values(), pa.int64()),
                ],
                ["lang", "chunk", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if not (tokens := tokens_of(text)):
                    continue
                starts = chunk_starts(words.of(tokens)).tolist()
                found = [(lang, b" ".join(tokens[a : b + OVERLAP])) for a, b in zip(starts, starts[1:])]
                counts.update(found)
                held += len(text) + 100 * len(found)
                if held > _HELD_BYTES:
                    yield flush()
                    counts, held = Counter(), 0
        if counts:
            yield flush()

    return rows.mapInArrow(task, "lang string, chunk string, n long").groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def pair_bits(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Place in the bitmap of each two consecutive words of a language."""
    return mix64(windows(hashes, 2) + np.uint64(xxhash.xxh64_intdigest(lang))) >> np.uint64(64 - FILTER_BITS)


def count_in_chunks(
    lang: str, chunks: list[bytes], weights: np.ndarray, sizes: range, likely: np.ndarray | None = None
) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """For each of the sizes the phrases of so many words and their counts in the chunks.

    All words together are the phrase without any. With ``likely``, a bitmap of pairs, a phrase
    with a pair outside of it is passed over. Phrases are told apart by a hash, then compared
    word by word with one that has it; those that only share the hash are told apart by their words.
    """
    tokens = b" ".join(chunks).split(b" ")
    lengths = np.fromiter((c.count(b" ") + 1 for c in chunks), np.int64, len(chunks))
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    weight = np.repeat(weights, lengths)
    is_word = ids != numbers.get(_WRITTEN, -1)
    starts = is_word.copy()
    for i in range(OVERLAP):
        starts[np.cumsum(lengths) - 1 - i] = False
    if 1 in sizes:
        counts = np.zeros(len(numbers), np.int64)
        np.add.at(counts, ids[starts], weight[starts])
        some, words = np.flatnonzero(counts), list(numbers)
        yield 1, [b"", *(words[i] for i in some.tolist())], np.concatenate([[counts.sum()], counts[some]])
    if sizes[-1] == 1:
        return
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))[ids]
    at = np.flatnonzero(starts)
    if likely is not None:
        pairs = pair_bits(lang, hashes)
        hit = (likely[(pairs >> np.uint64(3)).astype(np.int64)] >> (pairs & np.uint64(7)).astype(np.uint8)) & 1 == 1
    for size in range(2, sizes[-1] + 1):
        at = at[is_word[at + size - 1]]
        if likely is not None:
            at = at[hit[at + size - 2]]
        if size in sizes and len(at):
            yield size, *_told_apart(tokens, ids, weight, at, size, windows(hashes, size)[at])


def _told_apart(
    tokens: list[bytes], ids: np.ndarray, weight: np.ndarray, at: np.ndarray, size: int, hashes: np.ndarray
) -> tuple[list[bytes], np.ndarray]:
    """The distinct phrases that start ``at`` these places, and their weights."""
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    model = at[first[which]]
    same = np.ones(len(at), bool)
    for i in range(size):
        same &= ids[at + i] == ids[model + i]
    counts = np.zeros(len(first), np.int64)
    np.add.at(counts, which[same], weight[at[same]])
    phrases = [b" ".join(tokens[i : i + size]) for i in at[first].tolist()]
    if not same.all():
        others = Counter()
        for i in at[~same].tolist():
            others[b" ".join(tokens[i : i + size])] += int(weight[i])
        phrases += others
        counts = np.concatenate([counts, list(others.values())])
    return phrases, counts


def count_phrases(dictionary: DataFrame, sizes: range, likely: bytes | None = None) -> DataFrame:
    """``lang, phrase, size, n`` of the phrases of so many words of a dictionary of chunks.

    With ``likely``, a bitmap of :func:`likely_pairs`, phrases that cannot be frequent
    by it are left out. All words of a language together count as the empty phrase, of size 1.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(likely)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        waiting: dict[str, tuple[list, list]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (chunks, weights) in waiting.items():
                for size, phrases, counts in count_in_chunks(lang, chunks, np.array(weights, np.int64), sizes, bits):
                    for i in range(0, len(phrases), 200_000):
                        texts = pa.array(phrases[i : i + 200_000], pa.binary()).cast(pa.string())
                        n = len(texts)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * n, pa.string()),
                                texts,
                                pa.array(np.full(n, size, np.int32)),
                                pa.array(counts[i : i + 200_000], pa.int64()),
                            ],
                            ["lang", "phrase", "size", "n"],
                        )

        for batch in batches:
            for lang, chunk, n in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                chunks, weights = waiting.setdefault(lang, ([], []))
                chunks.append(chunk)
                weights.append(n)
                held += len(chunk)
                if held > 6 * _TOKENS:
                    yield from flush()
                    waiting, held = {}, 0
        yield from flush()

    counted = dictionary.select("lang", "chunk", "n").mapInArrow(task, _COUNTS)
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def likely_pairs(pairs: DataFrame) -> bytes:
    """Bitmap over the hashes of pairs of words (``lang, phrase``); at most 8 MB come to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [
                pair_bits(lang, np.array([xxhash.xxh64_intdigest(w) for w in pair.split(b" ")], np.uint64))[0]
                for lang, pair in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)))
            ]
            bit = np.array(bits, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((bit >> np.uint64(6)).astype(np.int32)), pa.array((bit & np.uint64(63)).astype(np.int32))],
                ["at", "bit"],
            )

    hashed = pairs.select("lang", "phrase").mapInArrow(task, "at int, bit int")
    table = hashed.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return bits.astype("<i8").tobytes()


def collocations(
    work: Workspace,
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    covered_percent: int = 100,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts, A-Z lower-cased, are parted into pieces at ``.,;:!?`` and line breaks, and pieces into words
    at spaces and tabs. A phrase has 2 to ``MAX_WORDS`` words of one piece and occurs ``a >= least`` times. Of
    its cuts into two parts, which occur ``l`` and ``r`` times, the one with the least
    ``floor(1000 * a * n / (l * r))`` counts, of equal ones the first; ``n`` are all words of
    the language. Phrases inside a longer one that has ``covered_percent`` of their count
    are left out. Order: score and ``a`` descending, then the phrase by its bytes.

    A null language is ``und``, and one with such a language; a null text is empty. Rows that repeat
    count as often as they are there; ids play no part. No rows, or no phrase that is
    frequent, give none. Other columns of ``docs`` are not read.
    """
    dictionary = work.cut(parse(docs, lang_col, text_col))
    frequent = (F.col("n") >= least) | (F.col("phrase") == "")
    short = work.cut(count_phrases(dictionary, range(1, 3)).filter(frequent))
    pairs = short.filter("size = 2")
    longer = work.cut(count_phrases(dictionary, range(3, MAX_WORDS + 1), likely_pairs(pairs)).filter(frequent))
    work.forget(dictionary)
    totals = short.filter("phrase = ''").select("lang", F.col("n").alias("total"))
    candidates = pairs.unionByName(longer)
    scored = work.cut(_scored(candidates, short.filter("phrase <> ''").unionByName(longer), totals))
    return work.result(_ranked(_uncovered(scored, candidates, covered_percent), top))


def _scored(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the cut that counts: ``lang, phrase, a, l, r, n, score``."""
    part = lambda start, length: F.array_join(F.slice(F.split("phrase", " "), start, length), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "k",
        F.col("n").alias("a"),
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size")).alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        counts = frequent.select("lang", F.col("phrase").alias(side), F.col("n").alias(count))
        cuts = lookup_join(cuts, counts, ["lang", side], salt=["phrase", "k"])
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    # Totals are repeated for each share of a language, so that no language is one task's.
    shares = F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))).alias("share")
    dealt = cuts.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES)).cast("int"))
    with_total = dealt.join(totals.select("lang", "total", shares), ["lang", "share"])
    score = F.expr("(1000 * big_a * big_n) div (big_l * big_r)").alias("score")
    return (
        with_total.select("*", *[exact(c).alias(f"big_{b}") for c, b in (("a", "a"), ("total", "n"), ("l", "l"), ("r", "r"))])
        .select("lang", "phrase", "a", F.col("total").alias("n"), F.struct(score, "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def _uncovered(scored: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """Without the phrases inside a longer one that has ``percent`` of their count."""
    words = F.split("phrase", " ")
    inner = (
        candidates.filter("size > 2")
        .select("lang", "n", "size", words.alias("words"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
        .select("lang", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    return (
        scored.join(inner, ["lang", "phrase"], "left")
        .filter(100 * F.coalesce("longer", F.lit(0)) < percent * F.col("a"))
        .drop("longer")
    )


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The best of each language: of parts of it first, so that no task ranks a whole one."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS))
    best = (
        scored.withColumn("part", part)
        .withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
        .filter(F.col("rank") <= top)
    )
    return (
        best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
