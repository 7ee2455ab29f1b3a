"""Queries over events: scans, selectors, counts, behaviours, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from ..functions import times as T
from ..operators import behaviors as B
from ..operators import counts as C
from ..operators import events as E
from ..operators import joins as J
from ..session import scratch_path
from ..sinks import exports as X
from . import tables as D
from .registry import plan

FROM, TO = "2024-01-05", "2024-01-20"
NAMES = ["purchase", "signup"]
_RANGE = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'"


def _range(spark, sf_dir, names=None) -> DataFrame:
    """Events of the range; the conditions are on the stored columns."""
    raw = D.table(spark, sf_dir, "events")
    return D.shaped(E.scan_events(raw, FROM, TO, names, "ts", "ts", "event_type"))


@plan(
    f"""
SELECT {D.UID} AS distinct_id, event_type AS event, count(*) AS n
FROM events JOIN customer ON c_custkey = user_id
WHERE {_RANGE} AND event_type IN ('purchase', 'signup')
GROUP BY 1, 2
"""
)
def counts_per_user_event(spark, sf_dir):
    return C.count_per_user_event(_range(spark, sf_dir, NAMES), D.customers(spark, sf_dir))


@plan("SELECT event_type AS event, count(*) AS n FROM events GROUP BY 1")
def counts_per_event(spark, sf_dir):
    return C.count_per_event(D.events(spark, sf_dir))


@plan(
    f"""
WITH counts AS (
  SELECT {D.UID} AS distinct_id, event_type AS key, CAST(count(*) AS VARCHAR) AS value
  FROM events JOIN customer ON c_custkey = user_id
  WHERE {_RANGE} AND event_type IN ('purchase', 'signup') GROUP BY 1, 2)
SELECT * FROM counts UNION ALL SELECT * FROM ({D.CUSTOMER_PROPS})
"""
)
def event_counts_to_profiles(spark, sf_dir):
    """Event counts of a range written to the profiles of the users who have them."""
    updated = C.event_counts_to_profiles(_range(spark, sf_dir, NAMES), D.customers(spark, sf_dir))
    return X.long_form(updated, "distinct_id")


@plan(
    f"""
SELECT CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day, event_type AS event, count(*) AS n
FROM events GROUP BY 1, 2
"""
)
def events_per_day(spark, sf_dir):
    """One output folder per day, read back and counted by folder."""
    path = scratch_path(spark, "per-day")
    X.export_events_per_day(D.events(spark, sf_dir), path)
    written = spark.read.option("basePath", path).text(path)
    return written.groupBy(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.get_json_object("value", "$.event").alias("event"),
    ).agg(F.count(F.lit(1)).alias("n"))


@plan(
    f"""
WITH d AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events GROUP BY 1),
days AS (SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM d)
SELECT CAST(strftime(day, '%Y-%m-%d') AS VARCHAR) AS day, count(*) AS active_users FROM days GROUP BY 1
"""
)
def day_enumeration(spark, sf_dir):
    """Every day between each user's first and last event, and users per day."""
    day = F.col("ts").cast("date")
    spans = D.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min(day).alias("a"), F.max(day).alias("b")
    )
    return (
        T.with_days(spans, "a", "b")
        .groupBy(T.day_text("day").alias("day"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )


@plan(
    f"""
WITH d AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events GROUP BY 1),
c AS (SELECT user_id, b, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS s FROM d)
SELECT {D.UID} AS distinct_id, CAST(strftime(s, '%Y-%m-%d') AS VARCHAR) AS chunk_start,
  CAST(strftime(least(CAST(s + INTERVAL 6 DAY AS DATE), b), '%Y-%m-%d') AS VARCHAR) AS chunk_end FROM c
"""
)
def date_chunks(spark, sf_dir):
    """Each user's active range in chunks of seven days."""
    day = F.col("ts").cast("date")
    spans = D.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min(day).alias("a"), F.max(day).alias("b")
    )
    return T.with_date_chunks(spans, "a", "b", 7).select(
        D.text_id("user_id").alias("distinct_id"),
        T.day_text("chunk_start").alias("chunk_start"),
        T.day_text("chunk_end").alias("chunk_end"),
    )


@plan(
    f"""
SELECT event_id, event_type AS event, {D.UID} AS distinct_id, {D.EPOCH_S} AS time FROM events
WHERE {_RANGE} AND event_type IN ('purchase', 'signup')
"""
)
def events_scan(spark, sf_dir):
    return _range(spark, sf_dir, NAMES).select("event_id", "event", "distinct_id", "time")


@plan(
    f"""
SELECT event_id, event_type AS event, {D.VALUE_CENTS} AS value_cents FROM events
WHERE event_type IN ('error', 'view')
"""
)
def event_selectors(spark, sf_dir):
    kept = D.table(spark, sf_dir, "events").where(
        Q.event_is([{"event": "error"}, {"event": "view"}], "event_type")
    )
    return kept.select(
        "event_id", F.col("event_type").alias("event"), D.cents("value").alias("value_cents")
    )


@plan(
    f"""
SELECT event_id, event_type AS event, {D.UID} AS distinct_id,
  CAST({D.EPOCH_MS} AS DOUBLE) / 1000.0 - 19800.0 AS time, {D.K} AS k
FROM events WHERE {_RANGE} AND event_type IN ('purchase', 'signup')
"""
)
def project_events(spark, sf_dir):
    """Event export in query form: listed properties, fractional seconds, half-hour zone."""
    source = _range(spark, sf_dir, NAMES)
    # The id rides along as a property, to tell rows apart.
    keyed = source.withColumn(
        "properties",
        P.overlay("properties", P.props_from_columns({"event_id": ("event_id", "bigint")})),
    )
    out = E.project_events(keyed, FROM, TO, NAMES, ["k", "event_id"], 5.5)
    return out.select(
        P.prop_bigint("properties", "event_id").alias("event_id"),
        "event",
        "distinct_id",
        "time",
        P.prop_bigint("properties", "k").alias("k"),
    )


@plan(
    f"""
SELECT event_id, 'k' AS key, CAST({D.K} AS VARCHAR) AS value FROM events
"""
)
def output_properties(spark, sf_dir):
    kept = D.events(spark, sf_dir).withColumn("properties", P.keep_props("properties", ["k", "absent"]))
    return X.long_form(kept, "event_id")


@plan(
    f"""
SELECT event_type AS event, CAST(sum({D.K}) AS BIGINT) AS k_sum,
  CAST(sum({D.VALUE_CENTS}) AS BIGINT) AS cents FROM events GROUP BY 1
"""
)
def prop_access(spark, sf_dir):
    return D.events(spark, sf_dir).groupBy("event").agg(
        F.sum(P.prop_bigint("properties", "k")).alias("k_sum"),
        F.sum(P.prop_bigint("properties", "value_cents")).alias("cents"),
    )


@plan(
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS distinct_id,
  CAST(count(event_id) FILTER (WHERE ts > TIMESTAMP '2024-01-23 18:30:00' AND event_type = 'purchase') AS BIGINT) AS bought_7d,
  CAST(count(event_id) AS BIGINT) AS seen_20d
FROM customer LEFT JOIN events ON user_id = c_custkey
  AND {D.EPOCH_S} > epoch(TIMESTAMP '2024-01-10 18:30:00') AND {D.EPOCH_S} <= epoch(TIMESTAMP '2024-01-30 18:30:00')
GROUP BY 1
"""
)
def behaviors(spark, sf_dir):
    """Purchases of seven days and any events of twenty, per profile, half-hour zone."""
    # 2024-01-30 13:00 UTC in a zone 5.5 hours ahead.
    as_of = T.epoch_of("2024-01-30") + 13 * 3600
    wanted = [
        {"window": "7d", "name": "bought_7d", "event_selectors": [{"event": "purchase"}]},
        {"window": "20d", "name": "seen_20d", "event_selectors": []},
    ]
    profiles = D.customers(spark, sf_dir)
    # The longest window on the stored column, so that the scan skips older days.
    recent = E.scan_events(
        D.table(spark, sf_dir, "events"), "2024-01-10", "2024-01-30", None, "ts", "ts"
    )
    out = B.with_behaviors(profiles, D.shaped(recent), wanted, as_of, 5.5)
    return out.select("distinct_id", "bought_7d", "seen_20d")


@plan(
    f"""
SELECT event_id, event_type AS event, {D.UID} AS distinct_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation
FROM events JOIN customer ON c_custkey = user_id
"""
)
def events_profiles_join(spark, sf_dir):
    joined = J.join_profiles(D.events(spark, sf_dir), D.customers(spark, sf_dir))
    return joined.select(
        "event_id",
        "event",
        "distinct_id",
        P.prop_string("profile_properties", "name").alias("name"),
        P.prop_bigint("profile_properties", "nation").alias("nation"),
    )


@plan(
    f"""
WITH aliases AS (
  SELECT CAST(c_custkey AS VARCHAR) AS alias,
    CAST(min(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey) AS VARCHAR) AS canonical_id FROM customer)
SELECT event_id, event_type AS event, coalesce(canonical_id, {D.UID}) AS distinct_id
FROM events LEFT JOIN aliases ON alias = {D.UID}
"""
)
def alias_resolve(spark, sf_dir):
    """Customers of one segment and nation count as one person."""
    people = D.table(spark, sf_dir, "customer")
    first = people.groupBy("c_mktsegment", "c_nationkey").agg(
        F.min("c_custkey").alias("canonical")
    )
    aliases = people.join(first, ["c_mktsegment", "c_nationkey"]).select(
        D.text_id("c_custkey").alias("alias"), D.text_id("canonical").alias("canonical_id")
    )
    events = D.events(spark, sf_dir).select("event_id", "event", "distinct_id")
    return J.resolve_alias(events, aliases)


@plan(
    f"""
SELECT event_id, {D.EPOCH_S} + 28800 AS west, {D.EPOCH_S} - 19800 AS half_hour, {D.EPOCH_S} AS utc FROM events
"""
)
def time_to_utc(spark, sf_dir):
    """Import and export shift, for offsets -8, 5.5 and 0 hours."""
    shifted = D.events(spark, sf_dir)
    return shifted.select(
        "event_id",
        T.to_utc("time", -8).alias("west"),
        T.to_utc("time", 5.5).alias("half_hour"),
        T.to_utc("time", 0).alias("utc"),
    )


@plan(
    f"""
SELECT event_id, CAST({D.EPOCH_S} * 1000 AS BIGINT) AS seen_ms,
  CAST(strftime(ts, '%Y%m%dT%H') AS VARCHAR) AS hour_stamp,
  {D.EPOCH_S} - {D.EPOCH_S} % 3600 AS hour_epoch FROM events
"""
)
def parse_last_seen(spark, sf_dir):
    """ISO time text and hour stamps to times and back."""
    raw = D.table(spark, sf_dir, "events")
    text = raw.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.date_format("ts", "yyyyMMdd'T'HH").alias("hour_stamp"),
    )
    return text.select(
        "event_id",
        T.epoch_ms(T.parse_iso("iso")).alias("seen_ms"),
        "hour_stamp",
        T.epoch_s(T.parse_hour_stamp("hour_stamp")).alias("hour_epoch"),
    )


@plan(
    """
SELECT key AS property, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'k' AS key FROM events UNION ALL SELECT 'value_cents' FROM events) GROUP BY 1
"""
)
def property_catalog(spark, sf_dir):
    return C.property_catalog(D.events(spark, sf_dir))


@plan(
    f"""
SELECT event_id, 'k' AS key, CAST({D.K} AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'type', '"' || event_type || '"' FROM events
UNION ALL SELECT event_id, 'value_cents', CASE WHEN event_type = 'error' THEN '0' ELSE CAST({D.VALUE_CENTS} AS VARCHAR) END FROM events
"""
)
def map_overlay(spark, sf_dir):
    """Three maps, the rightmost winning: errors' value is replaced."""
    base = D.events(spark, sf_dir)
    mid = P.props_from_columns({"type": ("event", "string"), "value_cents": (F.lit(0), "int")})
    top = F.when(F.col("event") != "error", P.keep_props("properties", ["value_cents"]))
    merged = P.overlay_all(P.keep_props("properties", ["k", "value_cents"]), mid, top)
    return X.long_form(base.withColumn("properties", merged), "event_id")
