import numpy as np
import pytest
from conftest import ODD

from cohortloom.llm import decontamination as D


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(docs, items, percent):
    sets = [(i, shingles(t)) for i, t in items]
    return sorted(
        (d, i, len(s & own), len(s)) for d, t in docs for own in [shingles(t)] for i, s in sets if s and 100 * len(s & own) >= percent * len(s)
    )


def items_of(spark, pairs):
    return spark.createDataFrame([(i, t, "x") for i, t in pairs], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_found_items_are_those_of_brute_force(spark, work, docs_of, block, monkeypatch):
    monkeypatch.setattr(D.item_blocks, "__defaults__", (block,))
    rng = np.random.default_rng(6)
    words = lambda n: [f"w{w}" for w in rng.integers(0, 3000, n)]
    items = [(i, " ".join(words(int(n)))) for i, n in enumerate(rng.integers(1, 60, 60))]
    docs = []
    for d in range(80):
        text = words(int(rng.integers(0, 3000)))
        for _ in range(rng.integers(0, 3)):
            item = items[rng.integers(0, len(items))][1].upper().split()
            if rng.random() < 0.5:
                item[int(rng.integers(0, len(item)))] = "changed"
            at = int(rng.integers(0, len(text) + 1))
            text[at:at] = item
        docs.append((d, " ".join(text)))
    docs += [(100 + i, t) for i, t in items[:10]]
    found = sorted(tuple(r) for r in D.find_contained(work, docs_of(docs), items_of(spark, items)).collect())
    assert found == brute_force(docs, items, 80)
    clean = D.drop_contaminated(work, docs_of(docs), items_of(spark, items))
    assert clean.columns == docs_of(docs).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted({d for d, _ in docs} - {f[0] for f in found})


def test_odd_rows(spark, work, docs_of):
    items = [(1, None), (2, ""), (3, "SHORT"), (None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six")]
    found = D.find_contained(work, docs_of(ODD), items_of(spark, items)).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found) == [(0, 4), (0, 4), (4, 4), (4, 4), (4, 4), (4, 4), (5, 3), (6, 3)]
    assert D.drop_contaminated(work, docs_of(ODD), items_of(spark, items)).count() == len(ODD) - 5


def test_no_items_and_no_documents(spark, work, docs_of):
    assert D.find_contained(work, docs_of(ODD), items_of(spark, [])).count() == 0
    assert D.drop_contaminated(work, docs_of(ODD), items_of(spark, [])).count() == len(ODD)
    assert D.find_contained(work, docs_of([]), items_of(spark, [(1, "a b")])).count() == 0
