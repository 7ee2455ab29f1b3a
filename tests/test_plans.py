"""What the physical plans must and must not do."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON = {
    "detect_format", "load_mixed_files", "delivery_results", "profile_delivery",
    "paged_profiles", "zip_archive",
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["events_scan", "counts_per_user_event", "project_events"])
def test_range_and_names_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = physical(entry.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(ts" in line and "In(event_type" in line for line in pushed), text


def test_columns_are_pruned(spark):
    text = physical(entry.queries()["counts_per_event"](spark, SF))
    assert "ReadSchema: struct<event_type:string>" in text


def test_counts_combine_before_the_shuffle(spark):
    text = physical(entry.queries()["event_counts_to_profiles"](spark, SF))
    assert "partial_count" in text


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - PYTHON - {"operation_counts"}))
def test_no_cross_joins_and_no_python(spark, name):
    text = physical(entry.queries()[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert banned not in text, banned
