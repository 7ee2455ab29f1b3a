import numpy as np
from conftest import ODD

from cohortloom.llm import toxicity as T

SETTINGS = T.FtrlSettings(l1=1.0)


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    settings = T.FtrlSettings()
    rows = T.training_rows(docs, labels, "crc32(cast(doc_id AS string)) % 3 <> 1", settings.max_rows)
    model = T.fit(rows, settings)
    assert 0 < len(model.features) < 20_000
    truth = {r["doc_id"]: r["toxic"] for r in labels.filter("crc32(cast(doc_id AS string)) % 3 = 1").collect()}
    found = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    clean = [found[d] >= 0.7 for d, y in truth.items() if y == 0]
    toxic = [found[d] >= 0.7 for d, y in truth.items() if y == 1]
    assert np.mean(clean) < 0.01 and np.mean(toxic) > 0.6
    kept = T.drop_toxic(docs, model, 0.7)
    assert kept.columns == docs.columns
    assert kept.count() == sum(s < 0.7 for s in found.values())


def test_the_sample_is_bounded_and_does_not_depend_on_order(spark, docs_of):
    docs = docs_of([(i, f"t {i}") for i in range(3000)], clash=False)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(1, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    one = {tuple(r) for r in T.training_rows(docs, labels, "true", 500).collect()}
    two = {tuple(r) for r in T.training_rows(docs.repartition(5), labels.repartition(3), "true", 500).collect()}
    assert one == two and 400 < len(one) < 600
    everything = {r["id"]: r["label"] for r in T.training_rows(docs, labels, "true", 10_000).collect()}
    assert len(everything) == 3000 and everything[1] == 1


def test_odd_rows(spark, docs_of):
    docs = docs_of([*ODD, (30, "vile words here"), (31, "kind words here")])
    labels = spark.createDataFrame([(30, 1), (31, 0), (1, 0), (2, 0)], "doc_id long, toxic int")
    model = T.fit(T.training_rows(docs, labels, "true", 100), SETTINGS)
    rows = T.score(docs, model).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert T.drop_toxic(docs, model, 1.1).count() == len(rows)


def test_no_labels_and_no_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(T.training_rows(docs_of([(1, "a")]), none, "true", 10), SETTINGS)
    assert [r["score"] for r in T.score(docs_of([(1, "a")]), model).collect()] == [0.5]
    assert T.score(docs_of([]), model).count() == 0
