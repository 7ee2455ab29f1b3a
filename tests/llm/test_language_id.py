from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD

from cohortloom.llm import language_id as L

PIECES = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = {p: i for i, p in enumerate(["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba"])}


def all_segmentations(word, p):
    marked = "▁" + word
    total = 0.0
    for n in range(len(marked)):
        for cuts in combinations(range(1, len(marked)), n):
            product = 1.0
            for a, b in zip((0, *cuts), (*cuts, len(marked))):
                piece = marked[a:b]
                fallback = p[len(VOCABULARY)] if len(piece) == 1 else 0.0
                product *= p[VOCABULARY[piece]] if piece in VOCABULARY else fallback
            total += product
    return total


@pytest.mark.parametrize("word", ["a", "ab", "abab", "bxa", "ababab"])
def test_forward_sums_all_segmentations(word):
    p = np.random.default_rng(1).random((len(VOCABULARY) + 2, 2))
    p[-1] = 0
    found = L.word_log_probabilities(["zz", word, "a"], VOCABULARY, p)[1]
    assert np.exp(found) == pytest.approx([all_segmentations(word, p[:, k]) for k in (0, 1)])


def test_long_words_and_pieces_are_summed_whole():
    p = np.random.default_rng(1).random((len(VOCABULARY) + 2, 1)) / 1000
    p[-1] = 0
    one = L.word_log_probabilities(["ab" * 2000, "x" * 3000], VOCABULARY, p)[:, 0]
    matrix = np.log(np.longdouble(p[:-1, 0]))
    logs = [np.longdouble(0)]
    marked = "▁" + "ab" * 2000
    for end in range(1, len(marked) + 1):
        parts = [logs[end - k] + matrix[VOCABULARY[marked[end - k : end]]] for k in range(1, 5) if k <= end and marked[end - k : end] in VOCABULARY]
        logs.append(np.logaddexp.reduce(parts))
    assert one[0] == pytest.approx(float(logs[-1])) and np.isfinite(one[1])
    assert max(map(len, L.pieces(PIECES))) == 16
    learned = L.learn_pieces(["ab" * 2000], np.array([1.0]), VOCABULARY, 2)
    assert np.isfinite(learned).all() and learned[VOCABULARY["ab"]] > learned[VOCABULARY["aba"]]


def test_learning_makes_its_words_likelier():
    words, counts = ["ab", "aba", "b"], np.array([5.0, 3.0, 1.0])
    likelihood = []
    for rounds in (0, 1, 2, 5):
        p = L.learn_pieces(words, counts, VOCABULARY, rounds)
        assert p[: len(VOCABULARY)].sum() == pytest.approx(1, abs=1e-6)
        likelihood.append(counts @ L.word_log_probabilities(words, VOCABULARY, p[:, None])[:, 0])
    assert likelihood[0] < likelihood[1] <= likelihood[2] + 1e-2 <= likelihood[3] + 2e-2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.fit(docs, PIECES, "crc32(cast(doc_id AS string)) % 4 <> 2", max_docs=100)
    assert model.languages == ["de", "en", "es", "fr"]
    found = {r["doc_id"]: r for r in L.predict(docs, model, PIECES).collect()}
    held_out = docs.filter("crc32(cast(doc_id AS string)) % 4 = 2").select("doc_id", "lang").collect()
    assert sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_odd_rows(spark, docs_of):
    docs = docs_of([*ODD, (20, "12 !? ½ _"), (21, "É")])
    model = L.fit(docs, PIECES, "doc_id < 9")
    rows = L.predict(docs, model, PIECES).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 20):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert (r["lang_pred"], r["score"]) == ("en", 1.0)


def test_nothing_learned(spark, docs_of):
    model = L.fit(docs_of([]), PIECES, "true")
    assert {r["lang_pred"] for r in L.predict(docs_of([(1, "some text")]), model, PIECES).collect()} == {"und"}
    assert L.predict(docs_of([]), model, PIECES).count() == 0


def test_the_sample_is_taken_before_a_shuffle(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plans, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a: plans.append(self) or real(self, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        L.fit(docs, PIECES, "doc_id > 0", max_docs=5)
        text = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
