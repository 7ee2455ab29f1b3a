from math import comb

import numpy as np
import pytest
from conftest import ODD

from cohortloom.llm import near_dedup as N
from cohortloom.llm.components import connected_components
from cohortloom.llm.workspace import Workspace


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(pairs, percent):
    sets = {i: shingles(t) for i, t in pairs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def families(seed, n_families, copies, words, edits):
    """Base texts and copies in which some words are replaced, so that links and near misses mix."""
    rng, out, i = np.random.default_rng(seed), [], 0
    for _ in range(n_families):
        base = [f"w{w}" for w in rng.integers(0, 5000, words)]
        for _ in range(copies):
            text = list(base)
            for at in rng.integers(0, words, rng.integers(0, edits + 1)):
                text[at] = f"x{rng.integers(0, 10**6)}"
            out.append((i, " ".join(text)))
            i += 1
    return [out[k] for k in rng.permutation(len(out))]


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("shape", [(12, 6, 120, 6), (1, 70, 150, 4)])
def test_groups_are_those_of_brute_force(work, docs_of, monkeypatch, percent, shape):
    monkeypatch.setattr(N, "_BLOCK", 8)
    pairs = [(i + 1, t) for i, t in families(percent, *shape)]
    found = N.near_duplicates(work, docs_of(pairs), percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute_force(pairs, percent)


def test_bitmaps_allow_every_true_link():
    rng = np.random.default_rng(5)
    for size in (5, 60, 600, 6000):
        for percent in (80, 85):
            for _ in range(20):
                both = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                apart = int(size * (100 - percent) / percent)
                a = np.unique(np.concatenate([both, rng.integers(0, 2**63, apart // 2, dtype=np.uint64)]))
                b = np.unique(np.concatenate([both, rng.integers(0, 2**63, apart - apart // 2, dtype=np.uint64)]))
                if 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)):
                    continue
                x, y = (N.odd_sketch(N.minhash(s), s).view(np.uint64) for s in (a, b))
                bits = np.bitwise_count(x ^ y)
                assert bits[:8].sum() <= N.most_differing_bits(percent)
                assert bits[8:].sum() <= N.most_full_bits(np.float64(len(a) + len(b)), percent)


def test_the_sketch_cuts_fewer_true_links_than_the_bands_miss():
    """Exact: binomial in the samples that differ, two flips each, parities of the bits they hit."""
    at = np.arange(N.SKETCH_BITS + 1)
    odd = [np.eye(N.SKETCH_BITS + 1)[0]]
    for _ in range(2 * N.SAMPLES):
        up, down = odd[-1] * (1 - at / N.SKETCH_BITS), odd[-1] * at / N.SKETCH_BITS
        odd.append(np.append(0, up[:-1]) + np.append(down[1:], 0))
    for percent in (80, 85):
        same = percent / 100
        over = [row[N.most_differing_bits(percent) + 1 :].sum() for row in odd[::2]]
        cut = sum(comb(N.SAMPLES, d) * (1 - same) ** d * same ** (N.SAMPLES - d) * p for d, p in enumerate(over))
        assert cut < 0.01 * (1 - same**N.BAND_ROWS) ** N.BANDS


def test_odd_rows(work, docs_of):
    rows = N.near_duplicates(work, docs_of(ODD), 85).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["doc_id"] in (1, 2, 3):
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (0, r["doc_id"], True)
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    kept = N.keep_one_per_group(work, docs_of(ODD), 80)
    assert kept.columns == docs_of(ODD).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8]


def test_no_rows(work, docs_of):
    assert N.near_duplicates(work, docs_of([]), 85).count() == 0


def test_components_are_those_of_union_find(spark, work):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = connected_components(work, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {n: find(n) for n in root if find(n) != n}


def test_one_id_on_texts_of_several_groups(work, docs_of):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    near = a + " more"
    docs = [(2, a), (4, b), (4, a), (5, near), (6, c), (6, c + " x"), (6, c), (7, ""), (7, None), (7, " "), (None, a),
            (8, d), (8, e), (9, d + " more"), (9, e + " more")]
    with Workspace(work.spark, "closed") as closed:
        rows = N.keep_one_per_group(closed, docs_of(docs))
    kept = sorted((r["doc_id"] or 0, r["text"] or "-") for r in rows.collect())
    (six,) = [t for i, t in kept if i == 6]
    assert six in (c, c + " x")
    assert kept == sorted([(2, a), (4, b), (6, six), (7, "-"), (7, "-"), (7, " "), (0, a), (8, d), (8, e)])
