import numpy as np
from conftest import ODD
from pyspark.sql import functions as F

from cohortloom.llm.line_dedup import MIN_WORDS, dedup_lines, within_one_word


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(pairs):
    lines = [(i, n, line.encode().split(), line) for i, t in sorted(pairs) if t is not None for n, line in enumerate(t.split("\n"))]
    out = {i: [] for i, _ in pairs}
    for k, (i, _, words, line) in enumerate(lines):
        near = lambda other: words == other or (
            min(len(words), len(other)) >= MIN_WORDS and abs(len(words) - len(other)) < 2 and distance(words, other) <= 1
        )
        if not words or not any(near(o[2]) for o in lines[:k]):
            out[i].append(line)
    return {i: None if t is None else "\n".join(out[i]) for i, t in pairs}


def test_lines_are_those_of_brute_force(work, docs_of):
    rng = np.random.default_rng(8)
    bases = [[f"w{w}" for w in rng.integers(0, 6, n)] for n in (3, 7, 8, 9, 12, 30)]
    pairs = []
    for i in range(60):
        lines = []
        for _ in range(rng.integers(0, 7)):
            words = list(bases[rng.integers(0, len(bases))])
            for _ in range(rng.integers(0, 3)):
                at = int(rng.integers(0, len(words)))
                kind = rng.integers(0, 3)
                words[at : at + (kind != 1)] = [f"w{rng.integers(0, 6)}"] if kind != 2 else []
            lines.append(("  " if rng.random() < 0.1 else " ").join(words) + ("\t" if rng.random() < 0.1 else ""))
        pairs.append((int(i * 11 % 60), "\n".join(lines)))
    rows = dedup_lines(work, docs_of(pairs).repartition(4)).collect()
    assert {r["doc_id"]: r["kept_text"] for r in rows} == brute_force(pairs)
    assert all(r["n_lines"] - r["n_dropped"] == len((r["kept_text"]).split("\n")) or r["kept_text"] == "" for r in rows)


def test_within_one_word(spark):
    rng = np.random.default_rng(3)
    rows = [tuple([f"{w}" for w in rng.integers(0, 2, n)] for n in rng.integers(1, 6, 2)) for _ in range(300)]
    for r in spark.createDataFrame(rows, "x array<string>, y array<string>").withColumn("ok", within_one_word(F.col("x"), F.col("y"))).collect():
        assert r["ok"] == (distance(r["x"], r["y"]) <= 1), r


def test_odd_rows(work, docs_of):
    rows = dedup_lines(work, docs_of([*ODD, (20, "a\n\nb\na"), (21, "\n" * 5000 + "b")])).collect()
    assert len(rows) == len(ODD) + 2
    kept = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows if r["doc_id"] not in (None, 4)}
    assert kept[1] == (0, 0, None) and kept[2] == (1, 0, "") and kept[6] == (1, 1, "")
    assert kept[20] == (4, 1, "a\n\nb") and kept[21] == (5001, 1, "\n" * 4999)
    assert all(r["n_dropped"] == 0 for r in rows if r["doc_id"] in (None, 4))


def test_the_least_length_is_the_callers(work, docs_of):
    pairs = [(1, "a b c d e"), (2, "a b x d e"), (3, "a b c d"), (4, "p q r s"), (5, "p q r t")]
    kept = {r["doc_id"]: r["kept_text"] for r in dedup_lines(work, docs_of(pairs), min_words=5).collect()}
    assert kept == {1: "a b c d e", 2: "", 3: "a b c d", 4: "p q r s", 5: "p q r t"}


def test_no_rows(work, docs_of):
    assert dedup_lines(work, docs_of([])).count() == 0


def test_texts_and_words_are_gone_through_once(work, docs_of, monkeypatch):
    plans, cut = [], work.cut
    monkeypatch.setattr(work, "cut", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cut(df))[1])
    dedup_lines(work, docs_of([(1, "a b c d e f g h\nb"), (2, "c")]))
    per_line = plans[0][: plans[0].index("Generate posexplode")]
    assert "text_hash" not in per_line and "xxhash64(text" not in per_line
    assert per_line.count("octet_length(replace(") == 1
    assert "trim(" not in per_line.replace("ltrim(", "").replace("trim(regexp_replace(", "")


def test_every_word_of_every_length_can_differ(work, docs_of):
    pairs, edits = [], 0
    for n in [*range(MIN_WORDS, 26), 31, 32, 33, 39, 40, 41, 63, 64, 65]:
        for at in range(n):
            for kind in ("replaced", "inserted", "deleted"):
                if kind == "deleted" and n == MIN_WORDS:
                    continue
                edits += 1
                words = [f"{edits}w{w}" for w in range(n)]
                other = words[:at] + {"replaced": ["x"], "inserted": ["x", words[at]], "deleted": []}[kind] + words[at + 1 :]
                pairs += [(2 * edits, " ".join(words)), (2 * edits + 1, " ".join(other))]
    rows = dedup_lines(work, docs_of(pairs, clash=False).repartition(4)).collect()
    assert {r["doc_id"]: r["kept_text"] for r in rows} == {i: "" if i % 2 else text for i, text in pairs}


def test_least_lengths_of_few_words(work, docs_of):
    rng = np.random.default_rng(5)
    pairs = [(i, " ".join(f"w{w}" for w in rng.integers(0, 4, rng.integers(1, 7)))) for i in range(60)]
    for least in (1, 2, 3):
        near = lambda a, b: a == b or (min(len(a), len(b)) >= least and distance(a, b) <= 1)  # noqa: B023, E731
        kept = {i: "" if any(near(o.split(), t.split()) for _, o in pairs[:i]) else t for i, t in pairs}
        assert {r["doc_id"]: r["kept_text"] for r in dedup_lines(work, docs_of(pairs), min_words=least).collect()} == kept
