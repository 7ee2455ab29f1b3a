import json

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import predicates as Q
from cohortloom.functions import properties as P
from cohortloom.operators import updates as U
from cohortloom.sources.csv_files import cell_text


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1", "1"), ("1.0", "1"), ("-0.5", "-0.5"), ("1e3", "1000"), ("462645.0", "462645"),
        ('"1"', '"1"'), ("null", "null"), ("true", "true"), ("[1.0,2]", "[1.0,2]"),
        ("123456789012345678901234567890", "123456789012345678901234567890"),
    ],
)
def test_canonical_numbers(spark, text, expected):
    assert one(spark, P.canonical(F.lit(text))) == expected


def test_parse_keeps_null_apart_from_absent(spark):
    m = one(spark, P.parse_props(F.lit('{"a":null,"b":"x","c":{"z":1,"y":[2.0]}}')))
    assert m == {"a": "null", "b": '"x"', "c": '{"y":[2],"z":1}'}


def test_parse_is_null_for_other_json(spark):
    assert one(spark, P.parse_props(F.lit("not json"))) is None


@pytest.mark.parametrize("value", ["plain", 'q"uote', "back\\slash", "new\nline", "é", "", "\t\x01"])
def test_text_round_trip(spark, value):
    text = one(spark, P.json_text(F.lit(value), "string"))
    assert json.loads(text) == value
    assert one(spark, P.unquoted(F.lit(text))) == value


def test_doubles_have_one_text(spark):
    rows = spark.createDataFrame([(462645.0,), (0.5,), (1.5e7,)], "d double")
    texts = [r["t"] for r in rows.select(P.json_text("d", "double").alias("t")).collect()]
    assert texts[0] == "462645" and texts[1] == "0.5" and texts[2] == "15000000"


def test_json_object_text_is_sorted_and_valid(spark):
    m = P.props_of({"b": 1, 'a"x': [1, "y"], "c": None})
    text = one(spark, P.props_to_json(m))
    assert json.loads(text) == {'a"x': [1, "y"], "b": 1, "c": None}
    assert text.index("a\\") < text.index('"b"')


def test_overlay_and_precedence(spark):
    a, b, c = P.props_of({"x": 1, "y": 1}), P.props_of({"y": 2, "z": 2}), P.props_of({"z": 3})
    assert one(spark, P.overlay_all(a, b, c)) == {"x": "1", "y": "2", "z": "3"}
    nothing = F.lit(None).cast(P.PROPS)
    assert one(spark, P.overlay(nothing, b)) == {"y": "2", "z": "2"}
    assert one(spark, P.overlay(b, nothing)) == {"y": "2", "z": "2"}


def test_rename_collision_prefers_target_spelling(spark):
    names = {"insert_id": "$insert_id", "$insert_id": "$insert_id", "a": "b"}
    both = P.props_of({"insert_id": "old", "$insert_id": "new", "a": None, "other": 1})
    assert one(spark, P.rename_props(both, names)) == {"$insert_id": '"new"', "b": "null"}
    only = P.props_of({"insert_id": "old"})
    assert one(spark, P.rename_props(only, names)) == {"$insert_id": '"old"'}


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("", None), ("123", "123"), ("1.5", "1.5"), ("true", "true"), ("True", '"True"'),
        ("null", "null"), ("NaN", '"NaN"'), ('"q"', '"q"'), ('[1,"a"]', '[1,"a"]'),
        ('{"b":1}', '{"b":1}'), ("Albany", '"Albany"'), ("Infinity", '"Infinity"'),
        ("12 monkeys", '"12 monkeys"'), ("1,2", '"1,2"'), ("[1] x", '"[1] x"'), ("[1]] x", '"[1]] x"'),
        ("[1],[2]", '"[1],[2]"'), ('{"b":1} x', json.dumps('{"b":1} x')), ('"q" x', json.dumps('"q" x')),
        ('{"b":1}} x', json.dumps('{"b":1}} x')), (" 5 ", "5"), ("007", '"007"'), ("1.50", "1.5"),
        ("nullable", '"nullable"'), ("-", '"-"'), ("[", '"["'),
    ],
)
def test_csv_cell(spark, cell, expected):
    assert one(spark, cell_text(F.lit(cell))) == expected


def apply(spark, op, m, v):
    out = one(spark, U.changed_props(op, P.props_of(m), P.props_of(v)))
    return {k: json.loads(t) for k, t in out.items()}


def test_add_edges(spark):
    m = {"n": 1.5, "t": "5", "l": [1]}
    v = {"n": -2, "new": 3, "t": 1, "l": 1}
    assert apply(spark, U.ADD, m, v) == {"n": -0.5, "new": 3, "t": "5", "l": [1]}


def test_append_edges(spark):
    m = {"l": [1], "e": [], "t": "x"}
    v = {"l": "1", "e": 2, "t": 3, "new": [4]}
    assert apply(spark, U.APPEND, m, v) == {"l": [1, "1"], "e": [2], "t": "x", "new": [[4]]}


def test_remove_edges(spark):
    m = {"l": [1, "1", 2, 1], "t": "x", "m": [1]}
    v = {"l": 1, "t": "x", "absent": 1}
    assert apply(spark, U.REMOVE, m, v) == {"l": ["1", 2], "t": "x", "m": [1]}


def test_union_edges(spark):
    m = {"l": [1, 1, "a"], "t": "x"}
    v = {"l": ["1", 1, "a", "b", "b"], "t": [1], "new": [2, 2]}
    out = apply(spark, U.UNION, m, v)
    assert out == {"l": [1, 1, "a", "1", "b"], "t": "x", "new": [2]}


def test_properties_of_updates(spark):
    m = {"a": 1, "l": [1]}
    once = apply(spark, U.SET, m, {"a": 2})
    assert apply(spark, U.SET_ONCE, once, {"a": 3}) == once
    united = apply(spark, U.UNION, m, {"l": [2]})
    assert apply(spark, U.UNION, united, {"l": [2]}) == united
    there = P.rename_prop(P.props_of(m), "a", "z")
    assert one(spark, P.rename_prop(there, "z", "a")) == {"a": "1", "l": "[1]"}


def test_rename_edges(spark):
    m = P.props_of({"old": 1, "new": 2})
    assert one(spark, P.rename_prop(m, "old", "new")) == {"new": "1"}
    assert one(spark, P.rename_prop(m, "old", "new", unset=False)) == {"old": "1", "new": "1"}
    assert one(spark, P.rename_prop(m, "absent", "x")) == {"old": "1", "new": "2"}
    assert one(spark, P.rename_prop(m, "old", "old")) == {"old": "1", "new": "2"}


def test_predicates(spark):
    m = P.props_of(
        {"s": "hello", "l": ["a", 1], "n": 0, "f": False, "e": "", "x": None, "t": "2024-01-01T00:00:00"}
    )
    cases = {
        "defined null": (Q.defined(m, "x"), True),
        "defined absent": (Q.defined(m, "q"), False),
        "substring": (Q.contains(m, "s", "ell"), True),
        "member": (Q.contains(m, "l", "a"), True),
        "not member": (Q.contains(m, "l", "1"), False),
        "in number": (Q.contains(m, "n", "0"), False),
        "in absent": (Q.contains(m, "q", "a"), False),
        "eq typed": (Q.equals(m, "n", "0"), False),
        "eq": (Q.equals(m, "n", 0), True),
        "before": (Q.before(m, "t", "2024-01-02"), True),
        "after": (Q.after(m, "t", "2024-01-02"), False),
        "before text": (Q.before(m, "s", "2024-01-02"), False),
        **{f"truthy {k}": (Q.truthy(m, k), k in ("s", "l", "t")) for k in "slnfext"},
        "truthy absent": (Q.truthy(m, "q"), False),
    }
    row = spark.range(1).select(*[c.alias(k) for k, (c, _) in cases.items()]).first().asDict()
    assert row == {k: v for k, (_, v) in cases.items()}
