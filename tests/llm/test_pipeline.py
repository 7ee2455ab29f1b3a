"""Each stage on its own input, and the whole run."""

import corpus_pipeline
import pytest
from conftest import ODD
from test_decontamination import brute_force as leaks
from test_near_dedup import brute_force as groups
from test_token_files import expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of each stage over the smallest tables."""
    folder, docs, made = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        made[name] = docs, after
        docs = after
    return made


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_and_columns(steps):
    assert list(steps) == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]
    for name, (before, after) in steps.items():
        if name != "token_files":
            assert after.dtypes == before.dtypes
            assert set(texts(after)) <= set(texts(before))


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {i for i, _ in texts(before)} - {i for i, _ in texts(after)}
    assert gone and all(labels.get(i, 1) == 1 for i in gone)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    want = groups(texts(before), corpus_pipeline.NEAR_PERCENT)
    assert [i for i, _ in texts(after)] == sorted(i for i, (_, _, kept) in want.items() if kept)


def test_documents_with_benchmark_items_go(spark, steps):
    before, after = steps["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, *_ in leaks(texts(before), items, corpus_pipeline.LEAK_PERCENT)}
    assert [i for i, _ in texts(after)] == sorted(i for i, _ in texts(before) if i not in bad)


def test_token_files_hold_the_mix(steps):
    before, after = steps["token_files"]
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in after.collect())
    assert found == expected(texts(before))


def test_run_gives_what_the_stages_give(spark, steps):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps["token_files"][1])


def test_odd_rows_and_no_rows(spark, docs_of):
    for pairs in (ODD, []):
        docs = docs_of(pairs)
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF)
            if name == "token_files":
                assert after.count() == docs.count()
            else:
                assert after.columns == docs.columns
                docs = spark.createDataFrame(after.collect(), after.schema)
