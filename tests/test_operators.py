import pytest
from pyspark.sql import functions as F

from cohortloom.operators import behaviors as B
from cohortloom.operators import events as E
from cohortloom.operators import joins as J
from cohortloom.operators import migration as M
from cohortloom.operators import revenue as R


@pytest.mark.parametrize(
    "props, strict, loose",
    [
        ({}, 0, 0),
        ({R.TRANSACTIONS: []}, 0, 0),
        ({R.TRANSACTIONS: [{"$amount": 1}, {"$amount": 2.5}]}, 3.5, 3.5),
        ({R.TRANSACTIONS: [{"$amount": 1}, {"x": 2}, {"$amount": 4}]}, 1, 5),
        ({R.TRANSACTIONS: [{"x": 2}, {"$amount": 4}]}, 0, 4),
        ({R.TRANSACTIONS: [{"$amount": 1}, {"$amount": None}, {"$amount": 4}]}, 1, 5),
        ({R.TRANSACTIONS: [{"$amount": 1}, {"$amount": "z"}, 5, {"$amount": 4}]}, 1, 5),
        ({R.TRANSACTIONS: "none"}, 0, 0),
    ],
)
def test_transaction_total(profiles_of, props, strict, loose):
    row = profiles_of({"a": props}).select(
        R.transaction_total().alias("s"), R.transaction_total(strict=False).alias("l")
    ).first()
    assert (row["s"], row["l"]) == (strict, loose)


def test_behavior_window_edges(spark, profiles_of):
    now, day = 1_700_000_000, 86400
    end = now + 19800
    rows = [("a", "e", end), ("a", "e", end - day), ("b", "e", end - day + 1), ("b", "f", end), ("a", "e", end + 1)]
    events = spark.createDataFrame(rows, "distinct_id string, event string, time bigint")
    wanted = [{"window": "1d", "name": "n", "event_selectors": [{"event": "e"}]}]
    out = B.with_behaviors(profiles_of({"a": {}, "b": {}, "c": {}}), events, wanted, now, 5.5)
    assert {r["distinct_id"]: r["n"] for r in out.collect()} == {"a": 1, "b": 1, "c": 0}
    with pytest.raises(RuntimeError):
        B.behavior_counts(events, wanted, now)
    with pytest.raises(ValueError):
        B.window_seconds("90 days")


def test_import_edges(spark):
    rows = [
        ("e", {"time": "100000", "distinct_id": '"a"'}),
        ("e", {"time": '"100000"', "distinct_id": '"b"'}),
        ("e", {"time": "null", "distinct_id": '"c"'}),
        ("e", {"distinct_id": '"d"'}),
        ("e", {"time": "1"}),
        ("e", None),
    ]
    raw = spark.createDataFrame(rows, "event string, properties map<string,string>")
    ready = E.shape_events(E.prepare_events(raw, "T", 5.5))
    got = {r["distinct_id"]: r["time"] for r in ready.collect()}
    assert got == {"a": 80200, "b": 80200, "c": None}
    assert E.invalid_events(raw).count() == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_do_not_change_a_join(spark, how):
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        "id",
        F.create_map(F.lit("p"), F.col("id")).alias("m"),
    ).unionByName(spark.createDataFrame([(None, 1, {"p": 1})], "k string, id bigint, m map<string,bigint>"))
    one = spark.range(40).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    one = one.unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    plain = many.join(one, "k", how).select("k", "id", "v").collect()
    dealt = J.lookup_join(many, one, ["k"], how, hot_rows=500).select("k", "id", "v").collect()
    assert sorted(map(str, plain)) == sorted(map(str, dealt))


def test_hot_key_is_spread_over_tasks(spark):
    many = spark.range(40_000).select(F.lit("hot").alias("k"), "id")
    one = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = J.lookup_join(many, one, ["k"], hot_rows=1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 30_000


def test_hot_key_list_is_bounded(spark):
    many = spark.range(10_000).select((F.col("id") % 10).cast("string").alias("k"))
    assert J.hot_keys(many, ["k"], 1000).count() == 0
    assert J.hot_keys(many, ["k"], 999).count() == 10


def test_migration_edges(spark):
    base = (
        '"event_type":"t","event_time":"2024-01-01 00:00:00.5","device_id":null,"ip_address":"i",'
        '"country":"c","event_properties":{"$os":"mine","p":1}'
    )
    rows = [
        "{%s,\"user_id\":\"\",\"amplitude_id\":7,\"user_properties\":{}}" % base,
        "{%s,\"user_id\":\"u\",\"amplitude_id\":7,\"user_properties\":{\"a\":1},\"os_name\":\"renamed\",\"insert_id\":\"x:1\"}" % base,
        "{%s,\"user_id\":\"u\",\"amplitude_id\":0,\"user_properties\":{\"Name\":\"N\"},\"$insert_id\":null}" % base,
        "{%s,\"user_id\":\"u\",\"amplitude_id\":7,\"user_properties\":{\"user_id\":\"z\"}}" % base,
    ]
    records = M.parse_records(spark.createDataFrame([(r,) for r in rows], "record string"))
    events = M.transform_events(records).collect()
    assert [e["distinct_id"] for e in events] == ["7", "u", "u", "u"]
    assert {e["time_ms"] for e in events} == {1704067200500}
    assert events[0]["properties"]["$os"] == '"mine"'
    assert events[1]["properties"]["$os"] == '"renamed"'
    assert events[1]["properties"]["$insert_id"] == '"x1"'
    assert events[2]["properties"]["$insert_id"] == "null"
    assert events[0]["properties"]["$device_id"] == "null"
    v3 = M.transform_events(records, identity_v3=True).collect()
    assert [e["properties"]["$user_id"] for e in v3] == ['"7"', '"u"', '"u"', '"u"']
    people = M.transform_profiles(records).collect()
    assert len(people) == 3
    assert people[0]["properties"] == {"a": "1", "$os": '"renamed"', "$insert_id": '"x:1"'}
    assert people[1]["properties"]["$name"] == '"N"'
    assert M.merge_pairs(records).count() == 1
    assert M.merge_pairs(records, distinct=False).count() == 2
    merge = M.merge_events(M.merge_pairs(records), 5).first()
    assert merge["properties"] == {"$distinct_ids": '["u","7"]'} and merge["distinct_id"] == ""


def test_projection_lets_listed_properties_win(spark):
    rows = [("e", "a", 1_704_067_200_000, {"distinct_id": '"b"', "time": "5", "k": "1"})]
    events = spark.createDataFrame(
        rows, "event string, distinct_id string, time_ms bigint, properties map<string,string>"
    )
    everything = E.project_events(events, "2024-01-01", "2024-01-01").first()
    assert (everything["distinct_id"], everything["time"]) == ("b", 5.0)
    listed = E.project_events(events, "2024-01-01", "2024-01-01", output_properties=["k"]).first()
    assert (listed["distinct_id"], listed["time"]) == ("a", 1_704_067_200.0)
    assert listed["properties"] == {"k": "1"}


def test_aliases(spark):
    events = spark.createDataFrame([("a", 1), ("b", 2)], "distinct_id string, n int")
    aliases = spark.createDataFrame([("a", "c")], "alias string, canonical_id string")
    out = J.resolve_alias(events, aliases)
    assert {(r["distinct_id"], r["n"]) for r in out.collect()} == {("c", 1), ("b", 2)}
    assert J.resolve_alias(events, aliases, ignore_alias=True) is events
