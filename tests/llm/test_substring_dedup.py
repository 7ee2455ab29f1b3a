import hashlib

import numpy as np
from conftest import ODD

from cohortloom.llm import substring_dedup as S
from cohortloom.llm.workspace import Workspace


def brute_force(pairs):
    texts = [(i, (t or "").encode()) for i, t in pairs]
    first = {}
    for i, b in texts:
        for p in range(len(b) - 49):
            if i is not None:
                first[b[p : p + 50]] = min(first.get(b[p : p + 50], i), i)
    rows = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if i is not None and first[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rows.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=repr)


def made(seed):
    """Texts that share passages of all lengths about 50, at edges and in the middle, and runs of one letter."""
    rng = np.random.default_rng(seed)
    word = lambda n: "".join(rng.choice(list("abcdé ñ"), n))
    shared = [word(n) for n in (30, 44, 49, 50, 51, 74, 75, 120, 400)] + ["z" * 90, "ab" * 60]
    out = []
    for i in range(120):
        parts = [word(int(rng.integers(0, 60)))]
        for _ in range(rng.integers(0, 4)):
            s = shared[rng.integers(0, len(shared))]
            a = int(rng.integers(0, max(1, len(s) - 40))) if rng.random() < 0.3 else 0
            parts += [s[a:], word(int(rng.integers(0, 30)))]
        out.append((int(i * 7 % 120), "".join(parts)))
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_removed_bytes_are_those_of_brute_force(work, docs_of):
    for seed in (1, 2):
        pairs = made(seed)
        with Workspace(work.spark, "seed") as own:
            assert found(S.remove_repeats(own, docs_of(pairs).repartition(3), chunk_bytes=3000)) == brute_force(pairs)


def test_odd_rows(work, docs_of):
    pairs = ODD + [(9, "x" * 60_000), (10, "word " * 20), (11, "y" * 49), (12, "y" * 49), (8, "q" + "x" * 80)]
    assert found(S.remove_repeats(work, docs_of(pairs), chunk_bytes=50_000)) == brute_force(pairs)


def test_no_rows(work, docs_of):
    assert S.remove_repeats(work, docs_of([])).count() == 0


def test_every_window_has_a_sample():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 200):
        text = rng.integers(0, letters, 3 * S._SLICE // 2, dtype=np.uint8)
        at = S.sample_positions(text, np.zeros(len(text), bool))
        assert at[0] < S.SPAN and np.diff(at).max() <= S.SPAN and len(text) - S.PREFIX - at[-1] < S.SPAN
        if letters == 200:
            assert len(at) < len(text) / 10
