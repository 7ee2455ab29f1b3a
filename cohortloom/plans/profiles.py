"""Queries over profiles: selectors, updates, duplicates, revenue, groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from ..operators import dedup as DD
from ..operators import events as E
from ..operators import folding
from ..operators import revenue as R
from ..operators import updates as U
from ..operators.groups import Groups
from ..sinks import exports as X
from ..sinks import imports as I
from . import tables as D
from .registry import plan

_ID = "CAST(c_custkey AS VARCHAR)"
_BALANCE = "CAST(round(c_acctbal * 100) AS BIGINT)"
_RICH = f"{_BALANCE} > 500000"


def _long(profiles: DataFrame) -> DataFrame:
    return X.long_form(profiles, "distinct_id")


# ------------------------------------------------------------------ selectors


@plan(f"SELECT {_ID} AS distinct_id, c_name AS name FROM customer WHERE {_RICH} AND c_mktsegment = 'MACHINERY'")
def profiles_scan(spark, sf_dir):
    wanted = Q.greater("properties", "balance_cents", 500000) & Q.equals(
        "properties", "segment", "MACHINERY"
    )
    return D.customers(spark, sf_dir).where(wanted).select(
        "distinct_id", P.prop_string("properties", "name").alias("name")
    )


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE key IN ('name', 'nation') AND distinct_id IN (
  SELECT {_ID} FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey < 5)
"""
)
def project_profiles(spark, sf_dir):
    """Profiles matching either selector, with two of their properties."""
    selectors = [Q.equals("properties", "segment", "BUILDING"), Q.less("properties", "nation", 5)]
    return _long(E.project_profiles(D.customers(spark, sf_dir), selectors, ["name", "nation"]))


@plan("SELECT group_id, key, value FROM (" + D.GROUP_PROPS + ") WHERE group_type = 'suppliers'")
def groups_scan(spark, sf_dir):
    return X.long_form(Groups("suppliers", "supplier").scan(D.groups(spark, sf_dir)), "group_id")


def _sparse(spark, sf_dir) -> DataFrame:
    """Customers lacking some properties: balance only when positive, VIP as a flag."""
    t = D.table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    return t.select(
        D.text_id("c_custkey").alias("distinct_id"),
        P.props_from_columns(
            {
                "segment": ("c_mktsegment", "string"),
                "debt": (F.when(F.col("c_acctbal") < 0, D.cents("c_acctbal")), "bigint"),
                "vip": (F.when(nation < 8, F.col("c_acctbal") > 5000), "boolean"),
                "zero": (F.when(nation > 15, F.lit(0)), "int"),
                "pair": (F.array(F.col("c_mktsegment"), nation.cast("string")), "array<string>"),
                "joined": (
                    F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(c_nationkey * 30)"),
                    "timestamp_ntz",
                ),
            }
        ).alias("properties"),
    )


@plan(f"SELECT {_ID} AS distinct_id, c_acctbal < 0 AS in_debt FROM customer")
def sel_defined(spark, sf_dir):
    return _sparse(spark, sf_dir).select(
        "distinct_id", Q.defined("properties", "debt").alias("in_debt")
    )


@plan(
    f"""
SELECT {_ID} AS distinct_id, c_mktsegment LIKE '%BUILD%' AS in_text,
  c_mktsegment = '7' OR CAST(c_nationkey AS VARCHAR) = '7' AS in_list FROM customer
"""
)
def sel_in(spark, sf_dir):
    """Substring of a string property, element of a list property."""
    return _sparse(spark, sf_dir).select(
        "distinct_id",
        Q.contains("properties", "segment", "BUILD").alias("in_text"),
        Q.contains("properties", "pair", "7").alias("in_list"),
    )


@plan(
    f"""
SELECT {_ID} AS distinct_id, c_mktsegment = 'MACHINERY' AS is_machinery,
  c_nationkey = 7 AS is_seven, FALSE AS is_text_seven FROM customer
"""
)
def sel_eq(spark, sf_dir):
    """Equality with type: the number 7 is not the text ``"7"``."""
    return D.customers(spark, sf_dir).select(
        "distinct_id",
        Q.equals("properties", "segment", "MACHINERY").alias("is_machinery"),
        Q.equals("properties", "nation", 7).alias("is_seven"),
        Q.equals("properties", "nation", "7").alias("is_text_seven"),
    )


@plan(
    f"""
SELECT {_ID} AS distinct_id,
  TIMESTAMP '2020-01-01' + to_days(CAST(c_nationkey * 30 AS INTEGER)) < TIMESTAMP '2020-06-01 12:00:00' AS early
FROM customer
"""
)
def sel_datetime(spark, sf_dir):
    return _sparse(spark, sf_dir).select(
        "distinct_id", Q.before("properties", "joined", "2020-06-01T12:00:00").alias("early")
    )


@plan(
    f"""
SELECT {_ID} AS distinct_id, c_nationkey < 8 AND c_acctbal > 5000 AS vip, FALSE AS zero, TRUE AS segment FROM customer
"""
)
def sel_boolean(spark, sf_dir):
    return _sparse(spark, sf_dir).select(
        "distinct_id",
        *[Q.truthy("properties", n).alias(n) for n in ("vip", "zero", "segment")],
    )


# -------------------------------------------------------------------- updates


def _changed(key: str, value: str, when: str = "TRUE") -> str:
    """Customer properties in long form with one of them replaced where ``when`` holds."""
    return f"""
SELECT distinct_id, key, value FROM ({D.CUSTOMER_PROPS})
WHERE NOT (key = '{key}' AND distinct_id IN (SELECT {_ID} FROM customer WHERE {when}))
UNION ALL SELECT {_ID}, '{key}', {value} FROM customer WHERE {when}"""


@plan(
    _changed("nation", "'-1'", _RICH)
    + f" UNION ALL SELECT {_ID}, 'tier', '\"gold\"' FROM customer WHERE {_RICH}"
)
def profile_set(spark, sf_dir):
    """Overwrite one property and add another, on the profiles a predicate picks."""
    rich = Q.greater("properties", "balance_cents", 500000)
    return _long(U.set_properties(D.customers(spark, sf_dir), {"tier": "gold", "nation": -1}, rich))


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT {_ID}, 'tier', '"basic"' FROM customer
"""
)
def profile_set_once(spark, sf_dir):
    return _long(U.set_once(D.customers(spark, sf_dir), {"tier": "basic", "nation": -1}))


@plan(f"SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE key NOT IN ('nation', 'segment')")
def profile_unset(spark, sf_dir):
    return _long(U.unset(D.customers(spark, sf_dir), ["nation", "segment", "absent"]))


@plan(
    f"""
SELECT distinct_id, key, CASE WHEN key = 'balance_cents' THEN CAST(CAST(value AS BIGINT) - 250 AS VARCHAR) ELSE value END AS value
FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT {_ID}, 'visits', '3' FROM customer
"""
)
def profile_add(spark, sf_dir):
    """A negative amount, an absent property, and text that stays as it is."""
    return _long(
        U.add(D.customers(spark, sf_dir), {"balance_cents": -250, "visits": 3, "segment": 1})
    )


_TAGS = """(SELECT CAST(c_custkey AS VARCHAR) AS distinct_id,
  [ '"' || c_mktsegment || '"', CAST(c_nationkey AS VARCHAR), '"' || c_mktsegment || '"' ] AS tags FROM customer)"""


def _elements(key: str, expr: str) -> str:
    return f"""SELECT distinct_id, '{key}' AS key, CAST(i AS INTEGER) AS pos, l[i] AS value
FROM (SELECT distinct_id, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT distinct_id, {expr} AS l FROM {_TAGS}))"""


def _open(profiles: DataFrame) -> DataFrame:
    """List properties as one row per element, positions from 1."""
    opened = X.long_form(profiles, "distinct_id").select(
        "distinct_id", "key", F.posexplode_outer(P.open_list("value")).alias("pos", "value")
    )
    return opened.where(F.col("pos").isNotNull()).withColumn("pos", F.col("pos") + 1)


@plan(_elements("tags", "list_append(tags, '\"new\"')") + " UNION ALL " + _elements("fresh", "['7']"))
def profile_append(spark, sf_dir):
    return _open(U.append(D.tagged_customers(spark, sf_dir), {"tags": "new", "fresh": 7}))


@plan(_elements("tags", "list_filter(tags, lambda x: x <> '\"MACHINERY\"')"))
def profile_remove(spark, sf_dir):
    """Every copy goes; an absent property stays absent."""
    return _open(U.remove(D.tagged_customers(spark, sf_dir), {"tags": "MACHINERY", "absent": 1}))


@plan(
    _elements(
        "tags",
        "list_concat(tags, list_filter(['\"MACHINERY\"', '7', '\"7\"'], lambda x: NOT list_contains(tags, x)))",
    )
)
def profile_union(spark, sf_dir):
    """Text and number are told apart; copies already in the list stay."""
    return _open(U.union(D.tagged_customers(spark, sf_dir), {"tags": ["MACHINERY", 7, "7", 7]}))


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE distinct_id NOT IN (SELECT {D.UID} FROM events WHERE event_type = 'error')
"""
)
def profile_delete(spark, sf_dir):
    """Profiles of users who had errors go."""
    failing = D.table(spark, sf_dir, "events").where(F.col("event_type") == "error").select(
        D.text_id("user_id").alias("distinct_id")
    )
    return _long(U.delete(D.customers(spark, sf_dir), failing))


@plan(
    f"""
SELECT distinct_id, CASE WHEN key = 'segment' THEN 'market' ELSE key END AS key, value FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT {_ID}, 'title', '"' || c_name || '"' FROM customer
"""
)
def profile_rename(spark, sf_dir):
    """One property renamed, one copied under a new name, one that is not there."""
    renamed = U.rename_property(D.customers(spark, sf_dir), "segment", "market")
    copied = U.rename_property(renamed, "name", "title", unset=False)
    return _long(U.rename_property(copied, "absent", "present"))


@plan(
    f"""
WITH ids AS (SELECT DISTINCT {D.UID} AS distinct_id FROM events WHERE event_type = 'purchase'
  UNION SELECT CAST(c_custkey + 1000000000 AS VARCHAR) FROM customer WHERE c_nationkey = 3)
SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE NOT (key = 'segment' AND distinct_id IN (SELECT distinct_id FROM ids))
UNION ALL SELECT distinct_id, 'segment', '"BUYER"' FROM ids
"""
)
def targeted_set(spark, sf_dir):
    """Listed ids only; those without a profile get one."""
    buyers = D.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(
        D.text_id("user_id").alias("distinct_id")
    )
    strangers = D.table(spark, sf_dir, "customer").where(F.col("c_nationkey") == 3).select(
        (F.col("c_custkey") + 1000000000).cast("string").alias("distinct_id")
    )
    ids = buyers.unionByName(strangers)
    return _long(U.set_properties(D.customers(spark, sf_dir), {"segment": "BUYER"}, ids))


@plan(
    f"""
WITH v AS (SELECT user_id, CAST(max({D.VALUE_CENTS}) AS BIGINT) AS best FROM events GROUP BY 1)
SELECT {_ID} AS distinct_id, 'balance_cents' AS key, CAST({_BALANCE} + coalesce(best, 0) AS VARCHAR) AS value
FROM customer LEFT JOIN v ON user_id = c_custkey
UNION ALL SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE key <> 'balance_cents'
"""
)
def query_driven_update(spark, sf_dir):
    """Each user's largest event value is added to the balance."""
    best = (
        D.table(spark, sf_dir, "events")
        .groupBy(D.text_id("user_id").alias("distinct_id"))
        .agg(F.max(D.cents("value")).alias("best"))
    )
    value = F.create_map(F.lit("balance_cents"), F.col("best").cast("string"))
    return _long(U.update_from_rows(D.customers(spark, sf_dir), best, U.ADD, value, create=False))


def event_updates(spark, sf_dir) -> DataFrame:
    """Every event as an update of its user, in event order."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    cents = D.cents("value")
    kind = F.col("event_type")
    op = (
        F.when((kind == "error") & (k < 3), U.DELETE)
        .when((kind == "error") & (k < 50), U.UNSET)
        .when(kind == "error", U.REMOVE)
        .when(kind == "click", U.ADD)
        .when((kind == "view") & (k < 50), U.UNION)
        .when(kind == "view", U.APPEND)
        .when(kind == "purchase", U.SET)
        .otherwise(U.SET_ONCE)
    )
    payload = (
        F.when(op == U.UNSET, P.props_of({"last_cents": None, "segment": None}))
        .when(op == U.REMOVE, F.create_map(F.lit("seen"), (k % 7).cast("string")))
        .when(op == U.ADD, F.create_map(F.lit("clicks"), F.lit("1"), F.lit("k_sum"), k.cast("string")))
        .when(op == U.UNION, F.create_map(F.lit("seen"), F.concat(F.lit("["), (k % 7).cast("string"), F.lit(",100]"))))
        .when(op == U.APPEND, F.create_map(F.lit("seen"), (k % 7).cast("string")))
        .when(op == U.SET, F.create_map(F.lit("last_cents"), cents.cast("string")))
        .when(op == U.SET_ONCE, F.create_map(F.lit("first_k"), k.cast("string")))
    )
    return D.table(spark, sf_dir, "events").select(
        D.text_id("user_id").alias("distinct_id"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        payload.alias("payload"),
    )


# The fold, said with windows: fine for a check, not for a feed with busy users.
_MIXED = f"""
WITH e AS (SELECT {D.UID} AS distinct_id, user_id, event_id AS seq, event_type AS kind, {D.K} AS k, {D.VALUE_CENTS} AS cents FROM events),
cut AS (SELECT distinct_id, coalesce(max(seq) FILTER (WHERE kind = 'error' AND k < 3), -1) AS gone,
    coalesce(max(seq) FILTER (WHERE kind <> 'error'), -1) AS made FROM e GROUP BY 1),
live AS (SELECT e.*, gone FROM e JOIN cut USING (distinct_id) WHERE seq > gone),
stored AS (SELECT p.* FROM ({D.CUSTOMER_PROPS}) p LEFT JOIN cut USING (distinct_id)
    WHERE coalesce(gone, -1) = -1 AND NOT (key = 'segment' AND distinct_id IN (SELECT distinct_id FROM live WHERE kind = 'error' AND k >= 3 AND k < 50))),
unset AS (SELECT distinct_id, max(seq) AS at FROM live WHERE kind = 'error' AND k >= 3 AND k < 50 GROUP BY 1),
last_set AS (SELECT distinct_id, max(seq) AS at, arg_max(cents, seq) AS cents FROM live WHERE kind = 'purchase' GROUP BY 1),
ops AS (
  SELECT distinct_id, seq, 0 AS pos, CAST(k % 7 AS VARCHAR) AS elem, 'append' AS op FROM live WHERE kind = 'view' AND k >= 50
  UNION ALL SELECT distinct_id, seq, 0, CAST(k % 7 AS VARCHAR), 'union' FROM live WHERE kind = 'view' AND k < 50
  UNION ALL SELECT distinct_id, seq, 1, '100', 'union' FROM live WHERE kind = 'view' AND k < 50),
gone AS (SELECT distinct_id, CAST(k % 7 AS VARCHAR) AS elem, max(seq) AS at FROM live WHERE kind = 'error' AND k >= 50 GROUP BY 1, 2),
kept AS (SELECT o.*, row_number() OVER (PARTITION BY distinct_id, elem ORDER BY seq) AS nth
  FROM ops o LEFT JOIN gone g USING (distinct_id, elem) WHERE seq > coalesce(g.at, -1)),
lists AS (SELECT distinct_id, '[' || string_agg(elem, ',' ORDER BY seq, pos) || ']' AS value FROM kept
  WHERE op = 'append' OR nth = 1 GROUP BY 1)
SELECT distinct_id, key, value FROM stored
UNION ALL SELECT distinct_id, 'clicks', CAST(count(*) AS VARCHAR) FROM live WHERE kind = 'click' GROUP BY 1
UNION ALL SELECT distinct_id, 'k_sum', CAST(CAST(sum(k) AS BIGINT) AS VARCHAR) FROM live WHERE kind = 'click' GROUP BY 1
UNION ALL SELECT distinct_id, 'first_k', CAST(arg_min(k, seq) AS VARCHAR) FROM live WHERE kind = 'signup' GROUP BY 1
UNION ALL SELECT s.distinct_id, 'last_cents', CAST(cents AS VARCHAR) FROM last_set s LEFT JOIN unset u USING (distinct_id) WHERE s.at > coalesce(u.at, -1)
UNION ALL SELECT o.distinct_id, 'seen', coalesce(l.value, '[]') FROM (SELECT DISTINCT distinct_id FROM ops) o LEFT JOIN lists l USING (distinct_id)
"""


@plan(_MIXED)
def mixed_updates(spark, sf_dir):
    """All events as updates of all eight operations, several hundred per user, in order."""
    updated = folding.apply_updates(D.customers(spark, sf_dir), event_updates(spark, sf_dir))
    return _long(updated)


@plan(
    f"""
SELECT op AS operation, count(*) AS matched, CAST(sum(hit) AS BIGINT) AS applied FROM (
  SELECT 'set' AS op, CASE WHEN c_nationkey <> 7 THEN 1 ELSE 0 END AS hit FROM customer WHERE {_RICH}
  UNION ALL SELECT 'unset', 1 FROM customer WHERE c_nationkey < 5) GROUP BY 1
"""
)
def operation_counts(spark, sf_dir):
    """Profiles an update matched, and those it really changed."""
    people = D.customers(spark, sf_dir)
    runs = {
        "set": (U.SET, {"nation": 7}, Q.greater("properties", "balance_cents", 500000)),
        "unset": (U.UNSET, ["nation"], Q.less("properties", "nation", 5)),
    }
    rows = []
    for name, (op, value, targets) in runs.items():
        seen = Observation(name)
        out = U.update(people, op, value, targets, matched=seen)
        out.write.format("noop").mode("overwrite").save()
        rows.append((name, seen.get["matched"], seen.get["applied"]))
    return spark.createDataFrame(rows, "operation string, matched bigint, applied bigint")


# --------------------------------------------------------- ids, records, imports


def _odd_ids(spark, sf_dir) -> DataFrame:
    """Customers whose id is under one of two names, or under neither."""
    t = D.table(spark, sf_dir, "customer")
    n = F.col("c_nationkey")
    return t.select(
        F.when(n < 10, D.text_id("c_custkey")).alias("$distinct_id"),
        F.when(n.between(5, 20), F.concat(F.lit("alt-"), D.text_id("c_custkey"))).alias("distinct_id"),
        P.props_from_columns({"segment": ("c_mktsegment", "string"), "nation": (n, "int")}).alias("value"),
    )


@plan(
    f"""
SELECT CASE WHEN c_nationkey < 10 THEN {_ID} ELSE 'alt-' || {_ID} END AS distinct_id, CAST(c_nationkey AS BIGINT) AS nation
FROM customer WHERE c_nationkey <= 20
"""
)
def id_fallback(spark, sf_dir):
    return U.with_profile_id(_odd_ids(spark, sf_dir)).select(
        "distinct_id", P.prop_bigint("value", "nation").alias("nation")
    )


@plan(
    f"""
SELECT distinct_id, '{{"$ignore_time":true,"$ip":0,"$ignore_alias":false,"$token":"T1","$set":{{"nation":' || nation ||
  ',"segment":"' || segment || '"}},"$distinct_id":"' || distinct_id || '"}}' AS record
FROM (SELECT CASE WHEN c_nationkey < 10 THEN {_ID} ELSE 'alt-' || {_ID} END AS distinct_id,
  CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer WHERE c_nationkey <= 20)
"""
)
def update_records(spark, sf_dir):
    return U.update_records(_odd_ids(spark, sf_dir), "T1", U.SET)


@plan(
    """
SELECT CAST(s_suppkey AS VARCHAR) AS group_id,
  '{"$ignore_time":true,"$ip":0,"$token":"T1","$group_key":"supplier","$set":{"name":"' || s_name ||
  '","nation":' || CAST(s_nationkey AS VARCHAR) || '},"$group_id":"' || CAST(s_suppkey AS VARCHAR) || '"}' AS record
FROM supplier
"""
)
def group_update_records(spark, sf_dir):
    rows = D.table(spark, sf_dir, "supplier").select(
        D.text_id("s_suppkey").alias("$distinct_id"),
        P.props_from_columns({"name": ("s_name", "string"), "nation": ("s_nationkey", "int")}).alias("value"),
    )
    return U.group_update_records(rows, "T1", "supplier", U.SET)


@plan(
    f"""
WITH o AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1)
SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE NOT (key = 'segment' AND distinct_id IN (SELECT CAST(o_custkey AS VARCHAR) FROM o))
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'segment', '"ORDERED"' FROM o
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'last_status', '"' || status || '"' FROM o
"""
)
def import_profiles(spark, sf_dir):
    """Every order as an imported profile row; the latest of each customer counts."""
    incoming = D.table(spark, sf_dir, "orders").select(
        D.text_id("o_custkey").alias("distinct_id"),
        "o_orderkey",
        P.props_from_columns(
            {"last_status": ("o_orderstatus", "string"), "segment": (F.lit("ORDERED"), "string")}
        ).alias("properties"),
    )
    return _long(I.import_profiles(D.customers(spark, sf_dir), incoming, order="o_orderkey"))


@plan(
    f"""
WITH o AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS pr, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1)
SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE NOT (key = 'segment' AND distinct_id IN (SELECT CAST(o_custkey AS VARCHAR) FROM o))
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'priority', '"' || pr || '"' FROM o
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'orders', n FROM o
"""
)
def import_update_records(spark, sf_dir):
    """Every order as one raw record that sets, adds and unsets."""
    records = D.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit('{"$token":"T1","$distinct_id":"'),
            D.text_id("o_custkey"),
            F.lit('","$set":{"priority":'),
            P.json_text("o_orderpriority", "string"),
            F.lit('},"$add":{"orders":1},"$unset":["segment"]}'),
        ).alias("record"),
    )
    return _long(I.import_update_records(D.customers(spark, sf_dir), records, "o_orderkey"))


# --------------------------------------------------------------------- groups


@plan(
    f"""
SELECT group_type, group_id, key, value FROM ({D.GROUP_PROPS})
WHERE NOT (group_type = 'suppliers' AND key = 'nation')
UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), 'nation', CASE WHEN s_acctbal > 5000 THEN '99' ELSE CAST(s_nationkey AS VARCHAR) END FROM supplier
UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), 'big', 'true' FROM supplier WHERE s_acctbal > 5000
"""
)
def group_set(spark, sf_dir):
    context = Groups("suppliers", "supplier")
    big = Q.greater("properties", "balance_cents", 500000)
    out = context.set(D.groups(spark, sf_dir), {"big": True, "nation": 99}, big)
    return X.long_form(out, "group_type", "group_id")


@plan(
    f"""
SELECT group_type, group_id, key, value FROM ({D.GROUP_PROPS})
WHERE NOT (group_type = 'suppliers' AND group_id IN (SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R'))
"""
)
def group_delete(spark, sf_dir):
    """Suppliers with a large return go; a nation of the same id stays."""
    returned = D.table(spark, sf_dir, "lineitem").where(
        (F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R")
    ).select(D.text_id("l_suppkey").alias("group_id"))
    out = Groups("suppliers", "supplier").delete(D.groups(spark, sf_dir), returned)
    return X.long_form(out, "group_type", "group_id")


@plan(
    f"""
SELECT group_type, group_id, key, value FROM ({D.GROUP_PROPS}) WHERE NOT (group_type = 'suppliers' AND key = 'nation')
UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), 'lines', CAST((SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS VARCHAR)
  FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)
"""
)
def group_operation(spark, sf_dir):
    """A query's counts added to the groups they are about."""
    lines = (
        D.table(spark, sf_dir, "lineitem")
        .groupBy(F.lit("supplier").alias("group_key"), D.text_id("l_suppkey").alias("group_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    value = F.create_map(F.lit("lines"), F.col("n").cast("string"))
    out = U.update_from_rows(
        D.groups(spark, sf_dir), lines, U.ADD, value, keys=U.GROUP_KEYS, create=False
    )
    return X.long_form(out, "group_type", "group_id")


@plan(
    f"""
SELECT group_type, group_id, key, value FROM ({D.GROUP_PROPS})
UNION ALL SELECT 'regions', CAST(n_regionkey AS VARCHAR), 'nations', CAST(count(*) AS VARCHAR) FROM nation GROUP BY 2
"""
)
def import_groups(spark, sf_dir):
    """Groups of a type not there yet are created."""
    incoming = (
        D.table(spark, sf_dir, "nation")
        .groupBy(D.text_id("n_regionkey").alias("group_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("group_id", P.props_from_columns({"nations": ("n", "bigint")}).alias("properties"))
    )
    out = I.import_groups(D.groups(spark, sf_dir), incoming, Groups("regions", "region"))
    return X.long_form(out, "group_type", "group_id")


# --------------------------------------------------------- duplicates and revenue


def _cohorts(spark, sf_dir) -> DataFrame:
    """Customers matched on segment and nation, last seen at their latest event."""
    seen = (
        D.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("seen"))
    )
    joined = D.table(spark, sf_dir, "customer").join(
        seen, F.col("user_id") == F.col("c_custkey"), "left"
    )
    cohort = F.concat_ws("-", "c_mktsegment", D.text_id("c_nationkey"))
    mixed_case = F.when(F.col("c_acctbal") < 0, F.lower(cohort)).otherwise(cohort)
    debt = F.when(F.col("c_acctbal") < 1000, D.cents("c_acctbal"))
    return joined.select(
        D.text_id("c_custkey").alias("distinct_id"),
        P.props_from_columns(
            {
                "cohort": (mixed_case, "string"),
                "$last_seen": ("seen", "timestamp_ntz"),
                "name": ("c_name", "string"),
                "debt": (debt, "bigint"),
            }
        ).alias("properties"),
        F.col("c_custkey").alias("row"),
    )


_RANKED = f"""
ranked AS (
  SELECT c_custkey, c_name, c_acctbal, seen, lower(cohort) AS m, cohort,
    row_number() OVER (PARTITION BY lower(cohort) ORDER BY seen DESC NULLS LAST, c_custkey DESC) AS rn,
    count(*) OVER (PARTITION BY lower(cohort)) AS n
  FROM (SELECT c_custkey, c_name, c_acctbal, date_trunc('second', s.seen) AS seen,
      CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment || '-' || c_nationkey) ELSE c_mktsegment || '-' || c_nationkey END AS cohort
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS seen FROM events GROUP BY 1) s ON s.user_id = c_custkey))"""


@plan(f"WITH {_RANKED} SELECT CAST(c_custkey AS VARCHAR) AS distinct_id FROM ranked WHERE rn > 1")
def dedup_delete_ids(spark, sf_dir):
    return DD.duplicate_ids(_cohorts(spark, sf_dir), "cohort", order="row")


@plan(
    f"""
WITH {_RANKED},
keep AS (SELECT * FROM ranked WHERE rn = 1),
lost AS (SELECT m, arg_max(CAST(round(c_acctbal * 100) AS BIGINT), -rn) FILTER (WHERE c_acctbal < 1000) AS debt FROM ranked WHERE rn > 1 GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS distinct_id, 'cohort' AS key, '"' || cohort || '"' AS value FROM keep
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'name', '"' || c_name || '"' FROM keep
UNION ALL SELECT CAST(c_custkey AS VARCHAR), '$last_seen', '"' || strftime(seen, '%Y-%m-%dT%H:%M:%S') || '"' FROM keep WHERE seen IS NOT NULL
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'debt', CAST(CASE WHEN c_acctbal < 1000 THEN CAST(round(c_acctbal * 100) AS BIGINT) ELSE debt END AS VARCHAR)
  FROM keep LEFT JOIN lost USING (m) WHERE c_acctbal < 1000 OR debt IS NOT NULL
"""
)
def dedup_merge_props(spark, sf_dir):
    """Keepers with what only their duplicates had, the newest of them first."""
    people = _cohorts(spark, sf_dir)
    return _long(DD.deduplicate(people, "cohort", merge_props=True, order="row"))


@plan(
    """
SELECT doc_id, lang, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(text) ORDER BY n_chars DESC, doc_id DESC) AS rn FROM documents)
WHERE rn = 1 OR text = ''
"""
)
def dedup_profiles(spark, sf_dir):
    """Documents as profiles whose text is the match property, over whole texts."""
    docs = D.table(spark, sf_dir, "documents").select(
        D.text_id("doc_id").alias("distinct_id"),
        P.props_from_columns({"text": ("text", "string"), "lang": ("lang", "string")}).alias(
            "properties"
        ),
        "doc_id",
    )
    left = DD.deduplicate(docs, "text", order="doc_id", only_truthy=True)
    return left.select(
        "doc_id",
        P.prop_string("properties", "lang").alias("lang"),
        F.md5(P.prop_string("properties", "text")).alias("text_md5"),
    )


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT {_ID}, 'Revenue', CAST(coalesce((SELECT CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) FROM orders WHERE o_custkey = c_custkey), 0) AS VARCHAR) FROM customer
"""
)
def revenue_from_transactions(spark, sf_dir):
    """Order totals in cents, per customer, from a transactions table."""
    orders = D.table(spark, sf_dir, "orders").select(
        D.text_id("o_custkey").alias("distinct_id"), D.cents("o_totalprice").alias("amount")
    )
    return _long(R.revenue_from_table(D.customers(spark, sf_dir), orders))


_PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@plan(
    f"""
SELECT l_orderkey, l_linenumber, {_PRICE} AS price, CAST(l_quantity AS BIGINT) AS quantity,
  CAST({_PRICE} + CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS DOUBLE) AS stopped,
  CAST({_PRICE} + CAST(l_quantity AS BIGINT) AS DOUBLE) AS skipped
FROM lineitem
"""
)
def revenue_from_lists(spark, sf_dir):
    """Each line as a profile with three transactions, the middle one sometimes without amount."""
    price, quantity = D.cents("l_extendedprice"), F.col("l_quantity").cast("bigint")
    middle = F.when(F.col("l_returnflag") == "N", F.lit('{"$amount":0}')).otherwise(
        F.lit('{"kind":"void"}')
    )
    listed = F.concat(
        F.lit('[{"$amount":'), price.cast("string"), F.lit("},"), middle,
        F.lit(',{"$amount":'), quantity.cast("string"), F.lit("}]"),
    )
    rows = D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        price.alias("price"),
        quantity.alias("quantity"),
        F.create_map(F.lit(R.TRANSACTIONS), listed).alias("properties"),
    )
    strict = R.revenue_from_lists(rows)
    return strict.select(
        "l_orderkey",
        "l_linenumber",
        "price",
        "quantity",
        P.prop_number("properties", R.REVENUE).alias("stopped"),
        R.transaction_total("properties", strict=False).alias("skipped"),
    )


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'label', '"' || c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) || '"' FROM customer
"""
)
def value_function(spark, sf_dir):
    """A property computed for each profile by a function of the profiles."""

    def label(profiles: DataFrame):
        text = F.concat_ws("-", P.prop_string("properties", "segment"), P.prop_string("properties", "nation"))
        return F.create_map(F.lit("label"), P.json_text(text, "string"))

    return X.long_form(U.update(D.customers(spark, sf_dir), U.SET, label), "distinct_id")
