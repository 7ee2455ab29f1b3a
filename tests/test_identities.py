import numpy as np
import pytest

from cohortloom.operators.identities import identity_clusters, merge_identities


def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        known = [x for x in (a, b) if x is not None]
        tops = sorted(map(find, known))
        for t in tops:
            root[t] = tops[0]
    return {x: find(x) for x in root}


def random_pairs():
    rng = np.random.default_rng(3)
    return [tuple(f"n{x}" for x in rng.integers(0, 300, 2)) for _ in range(140)]


CASES = {
    "chain": [(f"{i:03d}", f"{i + 1:03d}") for i in range(25)],
    "chain told backwards": [(f"{i + 1:03d}", f"{i:03d}") for i in range(25)],
    "zigzag": [(f"a{i:03d}", f"z{j:03d}") for i in range(20) for j in (i, i + 1)],
    "cycle": [(str(i), str((i + 1) % 12)) for i in range(12)],
    "hub": [("hub", f"leaf{i}") for i in range(200)] + [(f"p{i}", f"q{i}") for i in range(200)],
    "random": random_pairs(),
    "odd": [("a", None), (None, "b"), (None, None), ("c", "c"), ("d", "e"), ("d", "e"), ("e", "d"), ("", "f")],
}


@pytest.mark.parametrize("name", CASES)
def test_clusters_are_those_of_union_find(spark, name):
    df = spark.createDataFrame(CASES[name], "id_a string, id_b string").repartition(3)
    found = identity_clusters(df, hot_rows=30)
    rows = [tuple(r) for r in found.collect()]
    assert sorted(rows) == sorted(union_find(CASES[name]).items())


def test_no_pairs(spark):
    assert identity_clusters(spark.createDataFrame([], "id_a string, id_b string")).count() == 0


def test_rows_take_the_canonical_id(spark):
    pairs = spark.createDataFrame([("b", "c"), ("c", "a")], "id_a string, id_b string")
    events = spark.createDataFrame([(1, "c"), (2, "b"), (3, "x"), (4, None), (5, "a")], "n int, distinct_id string")
    merged = merge_identities(events, identity_clusters(pairs))
    assert {r["n"]: r["distinct_id"] for r in merged.collect()} == {1: "a", 2: "a", 3: "x", 4: None, 5: "a"}
