import json
import random

import pytest
from pyspark.sql import Observation, functions as F

from cohortloom.functions import predicates as Q
from cohortloom.functions import properties as P
from cohortloom.operators import folding, updates as U
from cohortloom.operators.groups import Groups


def replay(profiles, updates):
    """The updates one by one, as plain Python."""
    state = {k: dict(m) for k, m in profiles.items()}

    def number(x):
        return isinstance(x, (int, float)) and not isinstance(x, bool)

    for who, _, op, payload in sorted(updates, key=lambda u: (u[0], u[1])):
        if op == U.DELETE:
            state.pop(who, None)
            continue
        if who not in state:
            if op in (U.UNSET, U.REMOVE):
                continue
            state[who] = {}
        m = state[who]
        for k, text in (payload or {}).items():
            v = json.loads(text)
            if op == U.SET:
                m[k] = v
            elif op == U.SET_ONCE:
                m.setdefault(k, v)
            elif op == U.UNSET:
                m.pop(k, None)
            elif op == U.ADD:
                if k not in m or number(m[k]):
                    m[k] = m.get(k, 0) + v
            elif op == U.APPEND:
                if isinstance(m.setdefault(k, []), list):
                    m[k] = m[k] + [v]
            elif op == U.REMOVE:
                if isinstance(m.get(k), list):
                    m[k] = [e for e in m[k] if e != v]
            elif isinstance(m.setdefault(k, []), list):
                m[k] = m[k] + [e for e in v if e not in m[k]]
    return state


def random_value(rnd, op):
    def element():
        return json.dumps(rnd.choice(["a", "b", "c", 7]))

    if op in (U.SET, U.SET_ONCE):
        return rnd.choice([json.dumps("t"), "3", "[]", '["a","b","a"]', "[7]", "null"])
    if op == U.ADD:
        return str(rnd.randint(-3, 9))
    if op in (U.APPEND, U.REMOVE):
        return element()
    if op == U.UNION:
        return "[" + ",".join(dict.fromkeys(element() for _ in range(rnd.randint(0, 3)))) + "]"
    return "null"


@pytest.mark.parametrize("hot_rows", [2_000_000, 3])
def test_fold_equals_replay(spark, profiles_of, as_dict, hot_rows):
    """Random feeds, with and without keys spread over several shares."""
    rnd = random.Random(11 + hot_rows)
    people = {
        f"u{i}": {p: json.loads(random_value(rnd, U.SET)) for p in "xyz" if rnd.random() < 0.6}
        for i in range(120)
    }
    feed = []
    for i in range(200):
        # One user holds about a third of all updates.
        for seq in range(400 if i == 0 else rnd.randint(0, 8)):
            op = rnd.choice(
                U.OPERATIONS
                if rnd.random() < 0.5
                else [U.APPEND, U.REMOVE, U.UNION, U.ADD, U.SET_ONCE]
            )
            payload = (
                None
                if op == U.DELETE
                else {p: random_value(rnd, op) for p in "xyz" if rnd.random() < 0.6}
            )
            feed.append((f"u{i}", seq, op, payload))
    updates = spark.createDataFrame(
        feed, "distinct_id string, seq bigint, op string, payload map<string,string>"
    )
    out = folding.apply_updates(profiles_of(people), updates, hot_rows)
    assert as_dict(out) == replay(people, feed)


def test_fold_of_many_repeats_stays_small(spark, profiles_of, as_dict):
    """A hundred thousand updates of one property reduce before they meet."""
    updates = spark.range(100_000).select(
        F.lit("u").alias("distinct_id"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, U.ADD).otherwise(U.UNION).alias("op"),
        F.when(F.col("id") % 2 == 0, P.props_of({"n": 1})).otherwise(P.props_of({"l": ["a"]})).alias("payload"),
    )
    out = as_dict(folding.apply_updates(profiles_of({"u": {}}), updates, hot_rows=1000))
    assert out == {"u": {"n": 50_000, "l": ["a"]}}


def test_raw_records(spark, profiles_of, as_dict):
    rows = [
        (1, '{"$distinct_id":"a","$set":{"x":1.0}}'),
        (2, '{"distinct_id":"a","$unset":["y"],"$ip":0}'),
        (3, '{"$distinct_id":"b","$delete":""}'),
        (4, '{"$distinct_id":"c","$union":{"l":[1,"1"]}}'),
        (5, '{"$set":{"x":2}}'),
    ]
    feed = U.read_update_records(spark.createDataFrame(rows, "n bigint, record string"), "record", "n")
    out = folding.apply_updates(profiles_of({"a": {"y": 2}, "b": {"z": 1}}), feed)
    assert as_dict(out) == {"a": {"x": 1}, "c": {"l": [1, "1"]}}


def test_targets(spark, profiles_of, as_dict):
    people = profiles_of({"a": {"n": 1}, "b": {"n": 2}})
    ids = spark.createDataFrame([("b",), ("b",), ("c",), (None,)], "distinct_id string")
    assert as_dict(U.set_properties(people, {"n": 9}, ids)) == {
        "a": {"n": 1}, "b": {"n": 9}, "c": {"n": 9}
    }
    assert as_dict(U.unset(people, ["n"], ids)) == {"a": {"n": 1}, "b": {}}
    assert as_dict(U.delete(people, ids)) == {"a": {"n": 1}}
    assert as_dict(U.delete(people)) == {}
    by_value = U.set_properties(people, {"n": 0}, Q.greater("properties", "n", 1))
    assert as_dict(by_value) == {"a": {"n": 1}, "b": {"n": 0}}
    assert U.targets_of(people, ids).count() == 1


def test_dynamic_value(profiles_of, as_dict):
    people = profiles_of({"a": {"n": 1}, "b": {}})
    doubled = U.set_properties(
        people, lambda df: P.props_of({"m": P.json_text(P.prop_number(df["properties"], "n") * 2, "double")}),
        Q.defined("properties", "n"),
    )
    assert as_dict(doubled) == {"a": {"n": 1, "m": 2}, "b": {}}


def test_counts_matched_and_applied(spark, profiles_of):
    people = profiles_of({"a": {"n": 1}, "b": {"n": 2}, "c": {}})
    ids = spark.createDataFrame([("a",), ("b",), ("d",)], "distinct_id string")
    seen = Observation("set")
    U.update(people, U.SET, {"n": 1}, ids, matched=seen).collect()
    assert seen.get == {"matched": 3, "applied": 2}
    gone = Observation("gone")
    U.update(people, U.DELETE, None, Q.defined("properties", "n"), matched=gone).collect()
    assert gone.get == {"matched": 2, "applied": 2}


def test_unknown_operation(profiles_of):
    with pytest.raises(ValueError):
        U.update(profiles_of({"a": {}}), "$replace", {"n": 1})


def test_groups(spark):
    rows = [("t1", "k", "1", {"n": "1"}), ("t2", "j", "1", {"n": "1"})]
    groups = spark.createDataFrame(
        rows, "group_type string, group_key string, group_id string, properties map<string,string>"
    )
    context = Groups("t1", "k")
    assert context.scan(groups).count() == 1
    changed = {r["group_type"]: r["properties"]["n"] for r in context.set(groups, {"n": 2}).collect()}
    assert changed == {"t1": "2", "t2": "1"}
    assert [r["group_type"] for r in context.delete(groups).collect()] == ["t2"]
    with pytest.raises(ValueError):
        Groups().scan(groups)
    with pytest.raises(ValueError):
        Groups("t1").set(groups, {"n": 2})
    with pytest.raises(ValueError):
        Groups(group_key="k").delete(groups)
