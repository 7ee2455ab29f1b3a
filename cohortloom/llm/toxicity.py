"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.words import HashedWords, mix64
from cohortloom.session import ship_package

#: Features are hashed into so many bits.
FEATURE_BITS = 22
_WORD = re.compile(r"[^\W_]+")
#: Lengths of the beginnings of words that count as features.
_STARTS = (4, 5, 6)
_NEXT, _AFTER_NEXT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class FtrlSettings(NamedTuple):
    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.05
    epochs: int = 8
    #: Labelled rows to learn from: those whose id has the lowest hashes, so many on average.
    max_rows: int = 12_000


class Weights(NamedTuple):
    """The features whose weight L1 has not set to zero."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


class Features:
    """Hashed features of a text: words, pairs of neighbours, pairs with one word between.

    Inflected words share their beginning, so the first letters of each word
    count as words of their own too; without them words that were never seen in
    a labelled text would have no weight.
    """

    def __init__(self) -> None:
        self.words = HashedWords(xxhash.xxh64_intdigest)
        self.starts = [HashedWords(partial(_hash_start, n)) for n in _STARTS]

    def of(self, text: str | None) -> np.ndarray:
        found = _WORD.findall(text.lower()) if text else []
        if not found:
            return np.empty(0, np.int64)
        h = self.words.of(found)
        grams = [mix64(h), mix64(h[:-1] * _NEXT + h[1:]), mix64(h[:-2] * _AFTER_NEXT + h[2:])]
        grams += [mix64(s.of(found)) for s in self.starts]
        return (np.concatenate(grams) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _hash_start(letters: int, word: str) -> int:
    return xxhash.xxh64_intdigest(word[:letters] + "*")


def fit_ftrl(rows: list[tuple[np.ndarray, int]], s: FtrlSettings) -> Weights:
    """One pass per epoch over (distinct features, label), in the given order."""
    size = 1 << FEATURE_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(s.epochs):
        for at, label in rows:
            at = np.append(at, size)
            za, na = z[at], n[at]
            root = np.sqrt(na)
            shrunk = np.sign(za) * s.l1 - za
            w = np.where(np.abs(za) > s.l1, shrunk / ((s.beta + root) / s.alpha + s.l2), 0.0)
            w[-1] = -za[-1] / ((s.beta + root[-1]) / s.alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            grown = na + g * g
            z[at] = za + g - (np.sqrt(grown) - root) / s.alpha * w
            n[at] = grown
    root = np.sqrt(n)
    w = np.where(np.abs(z) > s.l1, (np.sign(z) * s.l1 - z) / ((s.beta + root) / s.alpha + s.l2), 0.0)
    used = np.flatnonzero(w[:size])
    return Weights(used, w[used], float(-z[size] / ((s.beta + root[size]) / s.alpha)))


def training_rows(
    docs: DataFrame, labels: DataFrame, learn_from: str, max_rows: int, id_col: str = "doc_id", label_col: str = "toxic"
) -> DataFrame:
    """``id, text, label``: a bounded sample of the labelled documents ``learn_from`` admits.

    Of several labels of one document the greatest counts. The sample takes ids
    by their hash, so it does not depend on order or partitions; its expected
    size is ``max_rows`` at most, which bounds what is broadcast to the scan of
    the texts (16 bytes a row).
    """
    usable = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .filter(learn_from)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).alias("label"))
    )
    share = min(1.0, max_rows / max(1, usable.count()))
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30))
    sample = usable.filter(place < int(share * (1 << 30)))
    return docs.select(F.col(id_col).alias("id"), F.col("text").alias("text")).join(F.broadcast(sample), "id")


def fit(rows: DataFrame, settings: FtrlSettings = FtrlSettings()) -> Weights:
    """Learn the weights of ``id, text, label`` in one task, in the order of a hash of the id.

    FTRL is sequential, so the bounded sample goes to one task; what returns are
    the few weights that are not zero. Without rows every score is one half.
    """
    ship_package(rows.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seen = Features().of, []
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.append((np.unique(of(text)).astype(np.int32), label))
        model = fit_ftrl(seen, settings)
        yield pa.RecordBatch.from_pydict(
            {"feature": np.append(model.features, -1), "weight": np.append(model.weights, model.bias)}
        )

    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "text").select("text", "label")
    found = ordered.mapInArrow(task, "feature long, weight double").toPandas()
    at, w = found["feature"].to_numpy(), found["weight"].to_numpy()
    return Weights(at[at >= 0], w[at >= 0], float(w[at < 0].sum()))


class _Scorer:
    def __init__(self, model: Weights):
        self.bias = model.bias
        self.weights = np.zeros(1 << FEATURE_BITS, np.float32)
        self.weights[model.features] = model.weights
        self.of = Features().of

    def scores(self, texts: pa.Array) -> np.ndarray:
        logits = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            at = self.of(text.as_py())
            logits[i] += self.weights[np.unique(at[self.weights[at] != 0])].sum(dtype=np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35)))


def drop_toxic(docs: DataFrame, model: Weights, reject_from: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``reject_from``; nothing is shuffled."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column(at)) < reject_from))

    return docs.mapInArrow(task, docs.schema)


def score(docs: DataFrame, model: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id_col, score``: probability of label 1, from the whole text.

    Each feature counts once however often it occurs. A null or empty text has
    no features: its score is that of the bias. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(batch.column(1)))], [id_col, "score"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col)).mapInArrow(
        task, f"{id_col} long, score double"
    )
