"""Queries over the vendor migration: raw records to events, profiles and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import properties as P
from ..functions import text as X
from ..functions import times as T
from ..operators import identities as I
from ..operators import migration as M
from ..operators import updates as U
from ..session import cut_lineage, scratch_path
from ..operators.events import shape_events
from ..sinks.exports import export_events, long_form
from ..sources import json_files
from . import tables as D
from .registry import plan

_MERGE_TIME = 1706659200000

# The raw records, said as columns.
_RAW = f"""raw AS (
SELECT event_id, event_type, user_id AS uid, {D.K} AS k, {D.EPOCH_MS} AS time_ms,
  CASE user_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN '0' ELSE 'u' || CAST(user_id AS VARCHAR) END AS user_id,
  user_id % 10 NOT IN (0, 1, 3) AS has_user,
  CASE WHEN {D.K} < 30 THEN NULL ELSE 'd' || CAST({D.K} AS VARCHAR) END AS device_id,
  CAST(user_id + 1000 AS VARCHAR) AS amplitude_id,
  'ev' || CAST(event_id AS VARCHAR) || event_type AS insert_id FROM events)"""

_WHO = "coalesce(CASE WHEN has_user THEN user_id END, nullif(device_id, ''), amplitude_id)"


def records(spark, sf_dir) -> DataFrame:
    return M.parse_records(D.vendor_records(spark, sf_dir))


def _event_key():
    """The event's number, from its cleaned insert id."""
    return F.regexp_extract(P.prop_string("properties", "$insert_id"), "^ev([0-9]+)", 1).cast("bigint")


def _ids(events: DataFrame) -> DataFrame:
    return events.withColumn("event_id", _event_key())


@plan(f"WITH {_RAW} SELECT event_id, event_type, user_id, device_id, amplitude_id FROM raw")
def amplitude_raw(spark, sf_dir):
    """Records written as a folder of gzipped lines and read as typed records."""
    path = scratch_path(spark, "vendor")
    lines = D.vendor_records(spark, sf_dir).select("record")
    lines.write.option("compression", "gzip").text(path)
    parsed = M.parse_records(json_files.read_records(spark, path))
    return parsed.select(
        F.regexp_extract(P.prop_string("fields", "$insert_id"), "^ev:([0-9]+)", 1)
        .cast("bigint")
        .alias("event_id"),
        "event_type",
        "user_id",
        "device_id",
        "amplitude_id",
    )


_EVENT_PROPS = f"""
SELECT event_id, '$device_id' AS key, coalesce('"' || device_id || '"', 'null') AS value FROM raw
UNION ALL SELECT event_id, 'ip', '"10.0.0.1"' FROM raw
UNION ALL SELECT event_id, 'mp_country_code', '"C' || CAST(k % 5 AS VARCHAR) || '"' FROM raw
UNION ALL SELECT event_id, 'k', CAST(k AS VARCHAR) FROM raw
UNION ALL SELECT event_id, 'platform', CASE WHEN k > 60 THEN '"ios"' ELSE 'null' END FROM raw
UNION ALL SELECT event_id, '$city', '"city' || CAST(k AS VARCHAR) || '"' FROM raw
UNION ALL SELECT event_id, '$os', CASE WHEN k < 50 THEN 'null' ELSE '"linux"' END FROM raw
UNION ALL SELECT event_id, '$insert_id', '"' || insert_id || '"' FROM raw"""


@plan(f"WITH {_RAW} {_EVENT_PROPS}")
def amplitude_events(spark, sf_dir):
    """All properties of all events: envelope, event properties, renamed fields."""
    return long_form(_ids(M.transform_events(records(spark, sf_dir))), "event_id")


@plan(
    f"""
WITH {_RAW} {_EVENT_PROPS}
UNION ALL SELECT event_id, 'source', '"amplitude"' FROM raw
UNION ALL SELECT event_id, '$user_id', '"' || {_WHO} || '"' FROM raw
"""
)
def amplitude_events_v3(spark, sf_dir):
    events = M.transform_events(records(spark, sf_dir), identity_v3=True)
    return long_form(_ids(events), "event_id")


@plan(f"WITH {_RAW} SELECT event_id, event_type AS event, {_WHO} AS distinct_id FROM raw")
def amplitude_distinct_id(spark, sf_dir):
    events = _ids(M.transform_events(records(spark, sf_dir)))
    return events.select("event_id", "event", "distinct_id")


@plan(f"SELECT event_id, {D.EPOCH_MS} AS time_ms, {D.EPOCH_S} * 1000 AS whole_ms FROM events")
def amplitude_time(spark, sf_dir):
    """Times with and without a fraction, to epoch milliseconds."""
    text = D.table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fraction"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("whole"),
    )
    return text.select(
        "event_id",
        T.epoch_ms(T.parse_export_time("fraction")).alias("time_ms"),
        T.epoch_ms(T.parse_export_time("whole")).alias("whole_ms"),
    )


@plan(
    f"""
WITH {_RAW}, rows AS (SELECT * FROM raw WHERE event_type <> 'error' AND user_id IS NOT NULL),
props AS (
  SELECT user_id, time_ms, 'last_type' AS key, '"' || event_type || '"' AS value FROM rows
  UNION ALL SELECT user_id, time_ms, 'Name', CASE WHEN k < 40 THEN '""' ELSE '"N' || CAST(uid AS VARCHAR) || '"' END FROM rows
  UNION ALL SELECT user_id, time_ms, '$name', '"N' || CAST(uid AS VARCHAR) || '"' FROM rows WHERE k >= 40
  UNION ALL SELECT user_id, time_ms, 'platform', CASE WHEN k > 60 THEN '"ios"' ELSE 'null' END FROM rows
  UNION ALL SELECT user_id, time_ms, '$city', '"city' || CAST(k AS VARCHAR) || '"' FROM rows
  UNION ALL SELECT user_id, time_ms, '$os', CASE WHEN k < 50 THEN 'null' ELSE '"linux"' END FROM rows
  UNION ALL SELECT user_id, time_ms, '$insert_id', '"ev:' || CAST(event_id AS VARCHAR) || '_#' || event_type || '"' FROM rows)
SELECT user_id AS distinct_id, key, arg_max(value, (time_ms, value)) AS value FROM props GROUP BY 1, 2
"""
)
def amplitude_profiles(spark, sf_dir):
    """Profile rows of all records, folded to one profile per user."""
    rows = M.transform_profiles(records(spark, sf_dir))
    return long_form(M.fold_profiles(rows), "distinct_id")


@plan(
    f"""
WITH {_RAW} SELECT user_id AS id_a, amplitude_id AS id_b, count(*) AS n FROM raw
WHERE has_user GROUP BY 1, 2
"""
)
def amplitude_merges(spark, sf_dir):
    """Identity pairs of all records, repeats kept, and how often each comes."""
    pairs = M.merge_pairs(records(spark, sf_dir), distinct=False)
    return pairs.groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("n"))


@plan(
    f"""
WITH {_RAW} SELECT DISTINCT '["' || user_id || '","' || amplitude_id || '"]' AS ids, CAST({_MERGE_TIME} AS BIGINT) AS time_ms,
  '$merge' AS event, '' AS distinct_id FROM raw WHERE has_user
"""
)
def merge_pairs_distinct(spark, sf_dir):
    events = M.merge_events(M.merge_pairs(records(spark, sf_dir)), _MERGE_TIME)
    return events.select(
        P.prop("properties", "$distinct_ids").alias("ids"), "time_ms", "event", "distinct_id"
    )


@plan(
    f"""
WITH {_RAW}
SELECT event_id, '$city' AS key, '"city' || CAST(k AS VARCHAR) || '"' AS value FROM raw
UNION ALL SELECT event_id, '$os', CASE WHEN k < 50 THEN 'null' ELSE '"linux"' END FROM raw
UNION ALL SELECT event_id, 'platform', CASE WHEN k > 60 THEN '"ios"' ELSE 'null' END FROM raw
UNION ALL SELECT event_id, '$insert_id', '"ev:' || CAST(event_id AS VARCHAR) || '_#' || event_type || '"' FROM raw
"""
)
def amplitude_rename(spark, sf_dir):
    """Known fields renamed, nulls kept, unknown ones dropped, one insert id."""
    renamed = records(spark, sf_dir).select(M.renamed_fields().alias("properties"))
    number = F.regexp_extract(P.prop_string("properties", "$insert_id"), "^ev:([0-9]+)", 1)
    return long_form(renamed.withColumn("event_id", number.cast("bigint")), "event_id")


@plan("SELECT doc_id, md5(regexp_replace(text, '[^a-zA-Z0-9-]', '', 'g')) AS cleaned FROM documents")
def insert_id_clean(spark, sf_dir):
    """The insert-id rule over whole document texts."""
    return D.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(X.clean_insert_id("text")).alias("cleaned")
    )


@plan(
    f"""
WITH {_RAW}, p AS (SELECT DISTINCT user_id FROM raw WHERE event_type <> 'error' AND user_id IS NOT NULL)
SELECT 'events' AS part, event_type AS name, count(*) AS n FROM raw GROUP BY 2
UNION ALL SELECT 'events', '$merge', count(*) FROM (SELECT DISTINCT user_id, amplitude_id FROM raw WHERE has_user) HAVING count(*) > 0
UNION ALL SELECT 'profiles', 'new', count(*) FROM p WHERE user_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) HAVING count(*) > 0
UNION ALL SELECT 'profiles', 'stored', count(*) FROM customer
"""
)
def amplitude_load(spark, sf_dir):
    """One export into the tables: profiles merged into the stored ones, events written."""
    path = scratch_path(spark, "load")
    # Parsed once; profiles, events and merges are then read from the typed table.
    parts = M.migrate(cut_lineage(records(spark, sf_dir), "records"), _MERGE_TIME)
    stored = D.customers(spark, sf_dir)
    U.update_from_rows(stored, parts["profiles"], U.SET, "properties").write.parquet(f"{path}/profiles")
    parts["events"].write.parquet(f"{path}/events")
    events = spark.read.parquet(f"{path}/events").groupBy(
        F.lit("events").alias("part"), F.col("event").alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))
    old = F.map_contains_key("properties", F.lit("balance_cents"))
    profiles = spark.read.parquet(f"{path}/profiles").groupBy(
        F.lit("profiles").alias("part"), F.when(old, "stored").otherwise("new").alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))
    return events.unionByName(profiles)


@plan(
    f"""
WITH {_RAW}
SELECT event_type AS event, {_WHO} AS distinct_id, time_ms // 1000 AS time, count(*) AS n FROM raw GROUP BY 1, 2, 3
UNION ALL SELECT '$merge', '', CAST({_MERGE_TIME} // 1000 AS BIGINT), count(*) FROM raw WHERE has_user HAVING count(*) > 0
"""
)
def amplitude_load_v3(spark, sf_dir):
    """Events and repeated merges of one export, written by the event export and read back."""
    path = scratch_path(spark, "load-v3")
    parts = M.migrate(cut_lineage(records(spark, sf_dir), "records"), _MERGE_TIME, identity_v3=True)
    export_events(parts["events"], path, compress=True)
    read = shape_events(json_files.read_events(spark, path))
    return read.groupBy("event", "distinct_id", "time").agg(F.count(F.lit(1)).alias("n"))


@plan(
    f"""
WITH RECURSIVE {_RAW}, pairs AS (
  SELECT DISTINCT user_id AS a, amplitude_id AS b FROM raw WHERE has_user
  UNION SELECT CAST(uid + 1000 AS VARCHAR), CAST(uid + 1001 AS VARCHAR) FROM raw WHERE uid % 25 <> 24
  UNION SELECT CAST(uid + 1000 AS VARCHAR), CAST(uid + 976 AS VARCHAR) FROM raw WHERE uid % 25 = 24 AND uid % 2 = 0),
arcs AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS id, a AS other FROM arcs UNION SELECT r.id, arcs.b FROM reach r JOIN arcs ON r.other = arcs.a),
clusters AS (SELECT id, min(other) AS canonical FROM reach GROUP BY id)
SELECT event_id, {_WHO} AS distinct_id, coalesce(canonical, {_WHO}) AS person FROM raw LEFT JOIN clusters ON id = {_WHO}
"""
)
def identity_clusters(spark, sf_dir):
    """Events by person: merges of the export, chains of vendor ids, every other chain closed to a cycle."""
    rows = cut_lineage(records(spark, sf_dir))
    users = D.table(spark, sf_dir, "events").select("user_id").where("user_id IS NOT NULL").distinct()
    name = lambda shift: (F.col("user_id") + shift).cast("string")
    closes = F.when((F.col("user_id") % 25 == 24) & (F.col("user_id") % 2 == 0), name(976))
    following = F.when(F.col("user_id") % 25 != 24, name(1001)).otherwise(closes)
    chains = users.select(name(1000).alias("id_a"), following.alias("id_b"))
    clusters = I.identity_clusters(M.merge_pairs(rows).unionByName(chains))
    events = _ids(M.transform_events(rows)).select("event_id", "distinct_id", F.col("distinct_id").alias("person"))
    return I.merge_identities(events, clusters, "person")
