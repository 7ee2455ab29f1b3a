"""The test tables in the shape of the model, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import properties as P
from ..functions import times as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_id(c: str) -> Column:
    return F.col(c).cast("string")


def cents(c: Column | str) -> Column:
    return F.round(P._col(c) * 100).cast("bigint")


def shaped(raw: DataFrame) -> DataFrame:
    """The ``events`` table (or part of it) as shaped events, with ``time_ms``."""
    extra = P.props_from_columns({"value_cents": (cents("value"), "bigint")})
    return raw.select(
        F.col("event_type").alias("event"),
        text_id("user_id").alias("distinct_id"),
        T.epoch_s("ts").alias("time"),
        T.epoch_ms("ts").alias("time_ms"),
        P.overlay(P.parse_props("props"), extra).alias("properties"),
        "event_id",
        "ts",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(table(spark, sf_dir, "events"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as user profiles."""
    return table(spark, sf_dir, "customer").select(
        text_id("c_custkey").alias("distinct_id"),
        P.props_from_columns(
            {
                "name": ("c_name", "string"),
                "segment": ("c_mktsegment", "string"),
                "nation": ("c_nationkey", "int"),
                "balance_cents": (cents("c_acctbal"), "bigint"),
            }
        ).alias("properties"),
    )


def tagged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with one list property ``tags``: segment, nation, segment again."""
    tags = P.close_list(
        F.array(
            P.json_text("c_mktsegment", "string"),
            P.json_text("c_nationkey", "int"),
            P.json_text("c_mktsegment", "string"),
        )
    )
    return table(spark, sf_dir, "customer").select(
        text_id("c_custkey").alias("distinct_id"),
        F.create_map(F.lit("tags"), tags).alias("properties"),
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` and ``supplier`` as two types of group profiles."""
    nations = table(spark, sf_dir, "nation").select(
        F.lit("nations").alias("group_type"),
        F.lit("nation").alias("group_key"),
        text_id("n_nationkey").alias("group_id"),
        P.props_from_columns(
            {"name": ("n_name", "string"), "region": ("n_regionkey", "int")}
        ).alias("properties"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("suppliers").alias("group_type"),
        F.lit("supplier").alias("group_key"),
        text_id("s_suppkey").alias("group_id"),
        P.props_from_columns(
            {
                "name": ("s_name", "string"),
                "nation": ("s_nationkey", "int"),
                "balance_cents": (cents("s_acctbal"), "bigint"),
            }
        ).alias("properties"),
    )
    return nations.unionByName(suppliers)


def raw_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files carry them, some lacking a required property.

    Errors with small ``k`` have no time, anything with large ``k`` no user, and
    views with small ``k`` an explicit null time.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    time = (
        F.when((F.col("event_type") == "error") & (k < 20), F.lit(None).cast("string"))
        .when((F.col("event_type") == "view") & (k < 10), F.lit("null"))
        .otherwise(T.epoch_s("ts").cast("string"))
    )
    user = F.when(k <= 90, P.json_text(text_id("user_id"), "string"))
    props = P.props_from_texts({"time": time, "distinct_id": user, "k": k.cast("string")})
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("event"), props.alias("properties")
    )


def vendor_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events reshaped to the vendor's raw export, one JSON text per row in ``record``.

    By the last digit of the user some come without a user id, with an empty one,
    with the string "0" or the number 0; errors carry no user properties. Both
    insert-id spellings appear.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    uid = F.col("user_id")
    q = lambda c: P.json_text(c, "string")
    odd = {0: "null", 1: '""', 2: '"0"', 3: "0"}
    user_id = F.coalesce(
        *[F.when(uid % 10 == digit, F.lit(text)) for digit, text in odd.items()],
        q(F.concat(F.lit("u"), uid.cast("string"))),
    )
    insert = F.concat(F.lit("ev:"), F.col("event_id").cast("string"), F.lit("_#"), F.col("event_type"))
    fields: dict[str, Column] = {
        "event_type": q("event_type"),
        "event_time": q(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
        "user_id": user_id,
        "device_id": F.when(k < 30, F.lit("null")).otherwise(q(F.concat(F.lit("d"), k.cast("string")))),
        "amplitude_id": (uid + 1000).cast("string"),
        "ip_address": F.lit('"10.0.0.1"'),
        "country": q(F.concat(F.lit("C"), (k % 5).cast("string"))),
        "city": q(F.concat(F.lit("city"), k.cast("string"))),
        "os_name": F.when(k < 50, F.lit("null")).otherwise(F.lit('"linux"')),
        "unknown_field": F.lit("1"),
        "$insert_id": q(insert),
        "insert_id": F.lit('"older spelling"'),
        "event_properties": F.concat(
            F.lit('{"k":'), k.cast("string"), F.lit(',"platform":"web","$city":"shadowed"}')
        ),
        "platform": F.when(k > 60, F.lit('"ios"')).otherwise(F.lit("null")),
        "user_properties": F.when(F.col("event_type") == "error", F.lit("{}")).otherwise(
            F.concat(
                F.lit('{"last_type":'),
                q("event_type"),
                F.lit(',"Name":'),
                F.when(k < 40, F.lit('""')).otherwise(q(F.concat(F.lit("N"), uid.cast("string")))),
                F.lit("}"),
            )
        ),
    }
    pairs = [F.concat(F.lit(P.literal_text(n) + ":"), c) for n, c in fields.items()]
    body = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return table(spark, sf_dir, "events").select(body.alias("record"), "event_id", "ts")


# ------------------------------------------------------------- the same in SQL

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
VALUE_CENTS = "CAST(round(value * 100) AS BIGINT)"
EPOCH_S = "CAST(epoch_us(ts) // 1000000 AS BIGINT)"
EPOCH_MS = "CAST(epoch_us(ts) // 1000 AS BIGINT)"
UID = "CAST(user_id AS VARCHAR)"

# Customers' properties in long form: distinct_id, key, value.
CUSTOMER_PROPS = """
SELECT CAST(c_custkey AS VARCHAR) AS distinct_id, 'name' AS key, '"' || c_name || '"' AS value FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', '"' || c_mktsegment || '"' FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'balance_cents', CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) FROM customer
"""

GROUP_PROPS = """
SELECT 'nations' AS group_type, 'nation' AS group_key, CAST(n_nationkey AS VARCHAR) AS group_id, 'name' AS key, '"' || n_name || '"' AS value FROM nation
UNION ALL SELECT 'nations', 'nation', CAST(n_nationkey AS VARCHAR), 'region', CAST(n_regionkey AS VARCHAR) FROM nation
UNION ALL SELECT 'suppliers', 'supplier', CAST(s_suppkey AS VARCHAR), 'name', '"' || s_name || '"' FROM supplier
UNION ALL SELECT 'suppliers', 'supplier', CAST(s_suppkey AS VARCHAR), 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'suppliers', 'supplier', CAST(s_suppkey AS VARCHAR), 'balance_cents', CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) FROM supplier
"""
