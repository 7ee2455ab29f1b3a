import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import ODD

from cohortloom.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [p.split() for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER).replace("\t", " "))]


def grams(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[i : i + m])] += 1
    return f, n


def brute_force(rows, least, top, percent=100):
    out = []
    counts, totals = grams(rows)
    for lang, f in counts.items():
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            cover = [b for h, b in f.items() if len(h) > len(g) and b >= least and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if any(100 * b >= percent * a for b in cover):
                continue
            score, k = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)] + ["É", "New", "york"]
    rows = []
    for i in range(150):
        n = int(rng.integers(0, 80))
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(n))
        if i % 3 == 0:
            text += " it is as broad as it is long, New York City Hall Park by the way. It is what it is"
        rows.append((("en", "de", None)[i % 3], text))
    rows += [("en", "one two three four five six seven eight nine ten")] * 40 + [("fr", "la la " * 700)]
    return rows


@pytest.fixture()
def docs(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(4)


@pytest.mark.parametrize("least,top,percent", [(20, 2000, 100), (5, 30, 60), (40, 5, 100)])
def test_phrases_are_those_of_brute_force(work, docs, rows, least, top, percent):
    found = C.collocations(work, docs, least, top, percent).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, least, top, percent)


def test_chunks_count_each_phrase_once(docs, rows):
    dictionary = C.parse(docs).collect()
    counts, _ = grams(rows)
    everything = np.full(1 << (C.FILTER_BITS - 3), 255, np.uint8)
    for lang, want in counts.items():
        mine = [r for r in dictionary if r["lang"] == lang]
        chunks, weights = [r["chunk"].encode() for r in mine], np.array([r["n"] for r in mine])
        for size, phrases, n in C.count_in_chunks(lang, chunks, weights, range(1, 6), everything):
            found = dict(zip([p.decode() for p in phrases], n.tolist()))
            assert found.pop("", None) == (sum(v for g, v in want.items() if len(g) == 1) if size == 1 else None)
            assert found == {" ".join(g): v for g, v in want.items() if len(g) == size}


def test_equal_hashes_are_told_apart(monkeypatch):
    text = C.tokens_of(b"a b c a b d a b c, c b a")
    chunk = b" ".join(text).replace(b"\xff", b"\n")
    everything = np.full(1 << (C.FILTER_BITS - 3), 255, np.uint8)
    windows = C.windows
    monkeypatch.setattr(C, "windows", lambda h, size: windows(h, size) % np.uint64(2))
    ((_, phrases, n),) = C.count_in_chunks("en", [chunk], np.array([3]), range(2, 3), everything)
    found = Counter()
    for p, c in zip(phrases, n.tolist()):
        found[p] += c
    assert found == {b"a b": 9, b"b c": 6, b"c a": 3, b"b d": 3, b"d a": 3, b"c b": 3, b"b a": 3}


def test_equal_passages_give_equal_chunks(spark):
    rng = np.random.default_rng(1)
    passage = " ".join(f"p{i}" for i in rng.integers(0, 500, 400))
    texts = [" ".join(f"q{i}" for i in rng.integers(0, 500, 50)) + " " + passage for _ in range(20)]
    chunks = C.parse(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"))
    assert chunks.filter("n = 20").count() > 15


def test_chunks_are_bounded():
    for text in ("same " * 5000, " ".join(f"v{i}" for i in range(5000))):
        tokens = C.tokens_of(text.encode())
        starts = C.chunk_starts(C.HashedWords().of(tokens))
        assert starts[0] == 0 and starts[-1] == 5000 and np.diff(starts).max() <= C._LONGEST


def test_odd_rows(work, docs_of):
    docs = docs_of([*ODD, *[(30, "New York. new york")] * 3, (31, ".,;"), (32, "\tA\t b ")])
    found = C.collocations(work, docs, least=2).collect()
    assert sorted(map(tuple, found)) == brute_force([(r["lang"], r["text"]) for r in docs.collect()], 2, 2000)


def test_no_rows(work, docs_of):
    assert C.collocations(work, docs_of([])).count() == 0
