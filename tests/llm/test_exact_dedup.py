from conftest import ODD

from cohortloom.llm.exact_dedup import DigestIndex


def decisions(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in df.collect())


def test_batches_are_deduplicated_against_the_index(spark, docs_of, tmp_path):
    index = DigestIndex(spark, str(tmp_path), 3)
    first = index.add(docs_of([(1, "a"), (5, "a"), (2, "b")]))
    assert decisions(first) == [(False, 1, 5, 2, False), (False, 2, 2, 1, True), (False, 5, 5, 2, True)]
    second = index.add(docs_of([(9, "a"), (8, "c"), (7, "a")]))
    assert decisions(second) == [(False, 7, 5, 2, False), (False, 8, 8, 1, True), (False, 9, 5, 2, False)]
    index.close()
    again = DigestIndex(spark, str(tmp_path), 3)
    third = again.add(docs_of([(20, "c"), (21, "d")]))
    assert [(r[1], r[4]) for r in decisions(third)] == [(20, False), (21, True)]
    assert spark.table(again.table).count() == 4


def test_odd_rows(spark, docs_of, tmp_path):
    rows = DigestIndex(spark, str(tmp_path), 2).add(docs_of(ODD)).collect()
    assert len(rows) == len(ODD)
    assert sum(r["kept"] for r in rows) == len({t or "" for _, t in ODD})
    repeated = [r for r in rows if r["keep_id"] == 4]
    assert len(repeated) == 3 and sum(r["kept"] for r in repeated) == 1


def test_no_rows(spark, docs_of, tmp_path):
    assert DigestIndex(spark, str(tmp_path), 2).add(docs_of([])).count() == 0
