import pytest
from conftest import ODD
from pyspark.sql import functions as F

from cohortloom.llm.mixing import mix, plan_mix, source_targets


def shared_out(sizes, weights=(1, 2, 3), most=3):
    """Reshares the excess step by step, as the rule is worded."""
    names = sorted(sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and free:
        total = sum(weight[n] for n in free)
        step = {n: left * weight[n] / total for n in free}
        left = 0.0
        for n, add in step.items():
            target[n] += add
            if target[n] > most * sizes[n]:
                left += target[n] - most * sizes[n]
                target[n] = float(most * sizes[n])
                free.discard(n)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 1, "d": 5}, {"a": 0, "b": 7}, {"x": 3}])
def test_targets(spark, sizes):
    rows = [(s, 1) for s, n in sizes.items() for _ in range(n)] + [(s, 0) for s in sizes]
    found = source_targets(spark.createDataFrame(rows, "source string, size long"), "source").collect()
    want = shared_out(sizes)
    assert {r["source"]: pytest.approx(r["target"]) for r in found} == want


def test_copies_come_near_the_targets_and_repeat(spark, docs_of):
    docs = docs_of([(i, "w " * (1 + i % 7)) for i in range(6000)])
    planned = plan_mix(docs).cache()
    for r in planned.groupBy("doc.source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t")).collect():
        assert abs(r["n"] - r["t"]) < 0.05 * r["t"]
    again = plan_mix(docs.repartition(7))
    key = lambda df: sorted((r["doc"]["doc_id"], r["copies"]) for r in df.collect())
    assert key(planned) == key(again)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == planned.agg(F.sum("copies")).first()[0]
    assert planned.agg(F.max("copies")).first()[0] <= 3


def test_odd_rows_and_no_rows(spark, docs_of):
    assert plan_mix(docs_of(ODD)).count() == len(ODD)
    assert mix(docs_of([])).count() == 0
    assert {r["copies"] for r in plan_mix(docs_of([(1, None), (2, "")])).collect()} == {0}
