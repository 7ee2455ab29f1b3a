"""Language of a text by unigram pieces, summed over all segmentations.

A language gives each piece of a fixed public vocabulary a probability. A word's
probability is the sum, over all ways to cut it into pieces, of the product of
their probabilities, found by a forward pass over its letters; a text's is the
product over its words. The piece probabilities are learned by expectation
maximisation: each word shares its count among pieces by their posterior
probability over all its segmentations.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import ship_package

UNKNOWN_LANGUAGE = "und"
_START = "▁"
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 250_000
_UNSEEN = 0.01
_UNKNOWN_CHARACTER = 1e-7


@lru_cache(maxsize=1)
def pieces(path: str) -> dict[str, int]:
    """Lower-case pieces of letters of a sentencepiece vocabulary, numbered."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    usable = (p for p in found if p == p.lower() and (p.removeprefix(_START).isalpha() or p == _START))
    return {p: i for i, p in enumerate(dict.fromkeys(usable))}


def text_words(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def _has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def piece_ids(words: list[str], vocabulary: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words by length: their places, and the piece of each length ending at each character.

    The second array is (character, piece length - 1, word), up to the longest piece
    there is. Where no piece fits it holds ``len(vocabulary) + 1``, whose probability is 0; a
    character that is no piece itself is ``len(vocabulary)``, the unknown one.
    """
    get, unknown, none = vocabulary.get, len(vocabulary), len(vocabulary) + 1
    longest = max(map(len, vocabulary), default=1)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w) + 1, []).append(i)
    for length, places in by_length.items():
        marked = [_START + words[i] for i in places]
        ids = np.full((length, min(longest, length), len(marked)), none, np.int32)
        for end in range(1, length + 1):
            ids[end - 1, 0] = [get(w[end - 1 : end], unknown) for w in marked]
            for n in range(2, min(end, longest) + 1):
                ids[end - 1, n - 1] = [get(w[end - n : end], none) for w in marked]
        yield np.array(places), ids


def forward(ids: np.ndarray, p: np.ndarray, shares: np.ndarray | None = None) -> np.ndarray:
    """Probability of the first characters over that of one character less, (characters + 1, words, languages).

    Ratios, since the probabilities themselves underflow in long words. ``before`` has for
    each length of a last piece what is ahead of it over what is ahead of the last character;
    ``shares`` takes for each piece the part of the probability that ends with it.
    """
    length, longest, n = ids.shape
    ratios = np.ones((length + 1, n, p.shape[1]))
    before = np.zeros((longest, n, p.shape[1]))
    before[0] = 1.0
    for end in range(1, length + 1):
        before[1:] = before[:-1] / ratios[end - 1]
        before[0] = 1.0
        if end == 1:
            before[1:] = 0.0
        ends_with = p[ids[end - 1]] * before
        ratios[end] = ends_with.sum(axis=0)
        if shares is not None:
            shares[end - 1] = (ends_with / ratios[end])[:, :, 0]
    return ratios


def word_log_probabilities(words: list[str], vocabulary: dict[str, int], p: np.ndarray) -> np.ndarray:
    """(words, languages): the logarithm of each word's sum over its segmentations."""
    out = np.empty((len(words), p.shape[1]))
    for places, ids in piece_ids(words, vocabulary):
        out[places] = np.log(forward(ids, p)).sum(axis=0)
    return out


def learn_pieces(words: list[str], counts: np.ndarray, vocabulary: dict[str, int], rounds: int = 3) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation, from equal ones.

    Backwards, each character's share of being a border is dealt to the pieces that end there.
    """
    size = len(vocabulary)
    groups = list(piece_ids(words, vocabulary))
    p = np.append(np.full(size, 1.0 / size), [_UNKNOWN_CHARACTER, 0.0])
    for _ in range(rounds):
        expected = np.zeros(size + 2)
        for places, ids in groups:
            length, longest, n = ids.shape
            shares = np.empty(ids.shape)
            forward(ids, p[:, None], shares)
            border = np.zeros((length + 1, n))
            border[length] = counts[places]
            for end in range(length, 0, -1):
                shares[end - 1] *= border[end]
                first = max(0, end - longest)
                border[first:end] += shares[end - 1, : end - first][::-1]
            expected += np.bincount(ids.ravel(), shares.ravel(), size + 2)
        known = expected[:size] + _UNSEEN
        p[:size] = known / known.sum() * (1 - _UNKNOWN_CHARACTER)
    return p


class LanguageModel(NamedTuple):
    languages: list[str]
    #: (pieces + 2, languages); the last rows are the unknown character and no piece.
    probabilities: np.ndarray


def fit(
    docs: DataFrame, vocabulary_path: str, learn_from: str, max_docs: int = 1500, rounds: int = 3, id_col: str = "doc_id"
) -> LanguageModel:
    """Learn from the texts of rows with a language that ``learn_from`` admits.

    Of each language a sample of ``max_docs`` documents on average is taken, by
    the hash of the id, before anything is shuffled: what each language's share is, a
    number per language of the model, goes to all tasks. The sample's words are counted in
    Spark; each language's distinct words go to one task, bounded by the sample. The model has one number per
    piece and language, whatever the size of the input.
    """
    spark = docs.sparkSession
    ship_package(spark)
    usable = docs.filter(learn_from).filter("lang IS NOT NULL AND text IS NOT NULL")
    share = usable.groupBy("lang").agg(F.least(F.lit(1.0), max_docs / F.count("*")).alias("share"))
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.select("lang", "text", place.alias("place")).join(F.broadcast(share), "lang").filter("place < share")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((lang, word) for word in text_words(text))
            langs, words = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = (
        sample.select("lang", "text")
        .mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("word")
        p = learn_pieces(group["word"].tolist(), group["n"].to_numpy(float), pieces(vocabulary_path), rounds)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "p": [p.tolist()]})

    found = counted.groupBy("lang").applyInPandas(learn, "lang string, p array<double>").orderBy("lang").toPandas()
    p = np.array(found["p"].tolist()).T if len(found) else np.empty((0, 0))
    return LanguageModel(found["lang"].tolist(), p)


class _WordScores(dict):
    """Log-probabilities of words met before; new ones are computed together."""

    def __init__(self, vocabulary: dict[str, int], p: np.ndarray):
        self.vocabulary, self.p = vocabulary, p
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.rows = np.empty((0, self.p.shape[1]))

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """(texts, languages): sums over the words of each text."""
        if len(self) > _CACHE_WORDS:
            self.forget()
        codes = [np.fromiter(map(self.__getitem__, ws), np.int64, len(ws)) for ws in texts]
        if self.new:
            added = [word_log_probabilities(self.new[i : i + 20_000], self.vocabulary, self.p) for i in range(0, len(self.new), 20_000)]
            self.rows = np.concatenate([self.rows, *added])
            self.new = []
        return np.array([self.rows[c].sum(axis=0) for c in codes])


def predict(
    docs: DataFrame, model: LanguageModel, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``id_col, lang_pred, score``: the likeliest language and its probability among all.

    The whole text counts. A null text, or one without a letter, is ``und`` with
    score 0; so is every text if nothing was learned. Languages are equally
    likely beforehand; of equal scores the first by name wins.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, p = shared.value
        scores = _WordScores(pieces(vocabulary_path), p) if languages else None
        for batch in batches:
            names, best = [], []
            for i in range(0, batch.num_rows, 500):
                texts = [text_words(t) if t else [] for t in batch.column(1).slice(i, 500).to_pylist()]
                told = [bool(languages) and _has_letter(ws) for ws in texts]
                sums = iter(scores.totals([ws for ws, ok in zip(texts, told) if ok]) if any(told) else ())
                for ok in told:
                    if not ok:
                        names.append(UNKNOWN_LANGUAGE)
                        best.append(0.0)
                        continue
                    row = next(sums)
                    at = int(row.argmax())
                    names.append(languages[at])
                    best.append(float(1.0 / np.exp(np.clip(row - row[at], -700, 0)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(best, pa.float64())], [id_col, "lang_pred", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(task, f"{id_col} long, lang_pred string, score double")
