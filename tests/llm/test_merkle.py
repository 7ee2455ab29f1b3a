import hashlib
from collections import defaultdict

import pytest
from conftest import ODD
from pyspark.sql import Row
from pyspark.sql import functions as F

from cohortloom.llm.merkle import FANOUT, fold, leaf_digest, merkle_manifest, proof_digest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(nodes):
    """Root and, for each node, the (before, after) of its run on every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = p // FANOUT * FANOUT
            paths[k].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + FANOUT])))
        at = [p // FANOUT for p in at]
        nodes = [h(*nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
    return nodes[0], paths


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    root, above = tree([tops[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (named, i, leaf), path in zip(sorted(groups[s]), tops[s][1]):
            out.append((i if named else None, s, leaf, tops[s][0], root, path + up))
    return out


def key(r):
    return tuple((v is not None, v if v is not None else "") for v in (r[1], r[2], str(r[0]), str(r[5])))


def found(df):
    return sorted(((r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in df.collect()), key=key)


@pytest.mark.parametrize("sizes", [(1,), (4,), (27,), (1, 1), (2, 40, 3, 1, 1, 1, 28)])
def test_trees_of_all_sizes(spark, work, sizes):
    names = [None, "", "é", "a", "Z", "b", "c"][: len(sizes)]
    rows = [
        Row(doc_id=(i * 7 + 3) % 101 * 10 + g, source=s, lang="en" if i % 2 else None, n_chars=i, text=f"text {i}\n é")
        for g, (s, n) in enumerate(zip(names, sizes)) for i in range(n)
    ]
    schema = "doc_id long, source string, lang string, n_chars int, text string"
    df = merkle_manifest(work, spark.createDataFrame(rows, schema).repartition(5))
    want = sorted(brute_force(rows), key=key)
    assert found(df) == want
    checked = df.select(
        (fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
        (fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("wrong"),
        proof_digest(F.col("path")).alias("proof"),
    ).collect()
    assert all(r["ok"] and not r["wrong"] for r in checked)
    assert sorted(r["proof"] for r in checked) == sorted(h("".join(a + b for a, b in w[5])) for w in want)


def test_odd_rows(work, docs_of):
    docs = docs_of([*ODD, *[(9, "same text")] * 30])
    assert found(merkle_manifest(work, docs)) == sorted(brute_force(docs.collect()), key=key)


def test_carried_columns_and_other_fields(work, docs_of):
    docs = docs_of([(1, "a\nb"), (2, "c"), (3, None)])
    rows = merkle_manifest(
        work, docs, fields=("text",), group_col="lang", carry={"bare": leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))}
    ).collect()
    assert {r["doc_id"]: (r["leaf"], r["bare"]) for r in rows} == {
        1: (h("3:a\nb"), h("2:ab")), 2: (h("1:c"), h("1:c")), 3: (h("-"), h("-")),
    }


def test_no_rows(work, docs_of):
    assert merkle_manifest(work, docs_of([])).count() == 0
