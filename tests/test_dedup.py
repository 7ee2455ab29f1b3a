from pyspark.sql import functions as F

from cohortloom.operators import dedup as D


def test_edges(profiles_of, as_dict):
    people = profiles_of(
        {
            "a1": {"$email": "A@x", "$last_seen": "2024-01-01T00:00:00", "only": 1, "both": 1},
            "a2": {"$email": "a@X", "$last_seen": "2024-01-03T00:00:00", "own": 2},
            "a3": {"$email": "a@x", "$last_seen": "2024-01-02T00:00:00", "both": 3},
            "n1": {"$email": None}, "n2": {"$email": None}, "m": {"other": 1},
            "x": {"$email": 1}, "y": {"$email": "1"},
            "p": {"$email": "p"}, "q": {"$email": "p", "$last_seen": "2020-01-01T00:00:00"},
        }
    )
    merged = as_dict(D.deduplicate(people, merge_props=True))
    assert set(merged) == {"a2", "n1", "n2", "m", "y", "q"}
    assert merged["a2"] == {
        "$email": "a@X", "$last_seen": "2024-01-03T00:00:00", "own": 2, "only": 1, "both": 3
    }
    assert as_dict(D.deduplicate(D.deduplicate(people))) == as_dict(D.deduplicate(people))
    exact = set(as_dict(D.deduplicate(people, case_sensitive=True)))
    assert {"a1", "a2", "a3"} <= exact


def test_ties_go_to_the_later_row(spark):
    rows = [("a", {"$email": '"e"'}, 2), ("b", {"$email": '"e"'}, 1)]
    people = spark.createDataFrame(
        rows, "distinct_id string, properties map<string,string>, row int"
    )
    assert [r[0] for r in D.duplicate_ids(people, order="row").collect()] == ["b"]


def test_one_value_shared_by_a_third(spark):
    people = spark.range(30_000).select(
        F.col("id").cast("string").alias("distinct_id"),
        F.create_map(
            F.lit("$email"),
            F.when(F.col("id") % 3 == 0, F.lit('"hot"')).otherwise(
                F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('"'))
            ),
            F.lit("p"), F.col("id").cast("string"),
        ).alias("properties"),
        "id",
    )
    assert D.duplicate_ids(people, order="id").count() == 9_999
    left = D.deduplicate(people, order="id", merge_props=True)
    assert left.count() == 20_001
    hot = left.where(F.col("properties")["$email"] == '"hot"').collect()
    assert [r["distinct_id"] for r in hot] == ["29997"]


def test_no_window_and_no_group_lists_for_survivors(spark, profiles_of):
    plan = D.deduplicate(profiles_of({"a": {"$email": "x"}}))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Window" not in text and "collect_list" not in text and "Cartesian" not in text
