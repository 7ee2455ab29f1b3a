"""Queries over sources and sinks: files written from the tables and read back."""

from __future__ import annotations

import base64
import gzip
import json
import zipfile
from collections.abc import Mapping
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from ..functions import times as T
from ..operators import batches as BA
from ..operators import events as E
from ..operators import updates as U
from ..session import cut_lineage, scratch_path, ship_package
from ..sinks import exports as X
from ..sinks import imports as I
from ..sinks.delivery import Delivery
from ..sources import archive, csv_files, detect, json_files, load, paged
from ..sources.files import create_file, list_folder, open_file
from . import tables as D
from .registry import plan

_KEYED = f"""SELECT event_id, event_type AS event, {D.UID} AS distinct_id, {D.EPOCH_S} AS time, {D.K} AS k, {D.VALUE_CENTS} AS value_cents FROM events"""


def keyed_events(spark, sf_dir) -> DataFrame:
    """Shaped events that carry their id as a property, to tell rows apart in files."""
    events = D.shaped(D.table(spark, sf_dir, "events"))
    keyed = P.overlay("properties", P.props_from_columns({"event_id": ("event_id", "bigint")}))
    return events.select("event", "distinct_id", "time", keyed.alias("properties"))


def _columns(events: DataFrame) -> DataFrame:
    return events.select(
        P.prop_bigint("properties", "event_id").alias("event_id"),
        "event",
        "distinct_id",
        "time",
        P.prop_bigint("properties", "k").alias("k"),
        P.prop_bigint("properties", "value_cents").alias("value_cents"),
    )


@plan(_KEYED)
def read_events_ndjson(spark, sf_dir):
    """Export as gzipped JSON lines, read back."""
    path = scratch_path(spark, "ndjson")
    X.export_events(keyed_events(spark, sf_dir), path, compress=True)
    return _columns(E.shape_events(json_files.read_events(spark, path)))


def _write_arrays(events: DataFrame, path: str, per_file: int = 2_000) -> None:
    """JSON arrays, a file each."""
    items = X.event_json(events).withColumn(
        "event_id", F.get_json_object("value", "$.properties.event_id").cast("bigint")
    )
    numbered = BA.number_batches(items, ["event_id"], per_file)
    payloads = BA.batch_payloads(numbered, "value", encode=False)
    payloads.select("batch_no", "payload").write.partitionBy("batch_no").text(path)


@plan(_KEYED)
def read_json_array(spark, sf_dir):
    path = scratch_path(spark, "array")
    _write_arrays(keyed_events(spark, sf_dir), path)
    raw = json_files.read_events(spark, path, whole_file=True)
    return _columns(E.shape_events(raw))


@plan(
    f"""
SELECT event_type AS event, count(*) AS n, CAST(sum({D.K}) AS BIGINT) AS k_sum FROM events GROUP BY 1
"""
)
def export_json(spark, sf_dir):
    """Export appended in two parts, then read as plain lines."""
    path = scratch_path(spark, "json")
    events = keyed_events(spark, sf_dir)
    errors = F.col("event") == "error"
    X.export_events(events.where(errors), path)
    X.export_events(events.where(~errors), path, append=True)
    lines = spark.read.text(path)
    return lines.groupBy(F.get_json_object("value", "$.event").alias("event")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.get_json_object("value", "$.properties.k").cast("bigint")).alias("k_sum"),
    )


@plan(_KEYED)
def csv_events(spark, sf_dir):
    """Export as CSV, one column per property, read back with types recovered."""
    path = scratch_path(spark, "csv-events")
    X.export_events(keyed_events(spark, sf_dir), path, "csv", compress=True)
    return _columns(csv_files.read_events(spark, path))


@plan(D.CUSTOMER_PROPS)
def csv_profiles(spark, sf_dir):
    path = scratch_path(spark, "csv-profiles")
    X.export_profiles(D.customers(spark, sf_dir), path, "csv")
    return X.long_form(csv_files.read_profiles(spark, path), "distinct_id")


@plan(f"SELECT group_type, group_id AS distinct_id, key, value FROM ({D.GROUP_PROPS})")
def csv_groups_all(spark, sf_dir):
    """Group profiles of all types as CSV, a folder per type, read back with their type."""
    path = scratch_path(spark, "csv-groups-all")
    X.export_groups(D.groups(spark, sf_dir), path)
    read = csv_files.read_groups(spark, path).withColumnRenamed("group_id", "distinct_id")
    return X.long_form(read, "group_type", "distinct_id")


@plan(
    f"""
SELECT * FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT {D.UID} || '-' || CAST(event_id AS VARCHAR), 'type', '"' || event_type || '"' FROM events WHERE user_id IS NOT NULL
UNION ALL SELECT {D.UID} || '-' || CAST(event_id AS VARCHAR), event_type, CAST(event_id AS VARCHAR) FROM events WHERE user_id IS NOT NULL
"""
)
def csv_append(spark, sf_dir):
    """Profiles as CSV, then more with other properties appended; each file read by its own header."""
    path = scratch_path(spark, "csv-append")
    X.export_profiles(D.customers(spark, sf_dir), path, "csv")
    t = D.table(spark, sf_dir, "events").where("user_id IS NOT NULL")
    number = F.col("event_id").cast("string")
    later = t.select(
        F.concat(D.text_id("user_id"), F.lit("-"), number).alias("distinct_id"),
        F.create_map(F.lit("type"), P.json_text("event_type", "string"), F.col("event_type"), number).alias("properties"),
    )
    X.export_profiles(later, path, "csv", append=True)
    return X.long_form(csv_files.read_profiles(spark, path), "distinct_id")


@plan(
    f"""
SELECT event_type AS event, {D.UID} AS distinct_id, {D.EPOCH_S} AS time, event_id FROM events
"""
)
def csv_time_converter(spark, sf_dir):
    """CSV events whose times are milliseconds, converted as they are read."""
    path = scratch_path(spark, "csv-times")
    events = D.events(spark, sf_dir)
    X.write_csv(events.select("event", "distinct_id", F.col("time_ms").alias("time"), "event_id"), path)
    read = csv_files.read_events(spark, path, time_converter=lambda c: F.floor(c.cast("bigint") / 1000))
    return read.select("event", "distinct_id", "time", P.prop_bigint("properties", "event_id").alias("event_id"))


@plan(
    f"""
SELECT event_type AS event, {D.UID} AS distinct_id, CAST({D.K} AS BIGINT) AS k FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-16'
"""
)
def export_projection(spark, sf_dir):
    """The query projection of some days, exported as JSON lines and read back."""
    path = scratch_path(spark, "projection")
    X.export_events(E.project_events(D.events(spark, sf_dir), "2024-01-05", "2024-01-15"), path, compress=True)
    read = json_files.read_events(spark, path)
    return read.select(
        "event",
        P.prop_string("properties", "distinct_id").alias("distinct_id"),
        P.prop_bigint("properties", "k").alias("k"),
    )


@plan(
    """
SELECT doc_id, CASE WHEN text <> '' THEN 'string' ELSE 'other' END AS kind, md5(nullif(text, '')) AS text_md5,
  CAST(n_chars AS BIGINT) AS number, lang = 'en' AS flag FROM documents
"""
)
def csv_cell_typing(spark, sf_dir):
    """Whole document texts, numbers, booleans and nested values through CSV and back.

    An empty text comes back as absent.
    """
    docs = D.table(spark, sf_dir, "documents")
    profiles = docs.select(
        D.text_id("doc_id").alias("distinct_id"),
        P.props_from_columns(
            {
                "text": ("text", "string"),
                "n": ("n_chars", "bigint"),
                "flag": (F.col("lang") == "en", "boolean"),
                "nested": (F.array("lang", "source"), "array<string>"),
            }
        ).alias("properties"),
    )
    path = scratch_path(spark, "csv-typing")
    X.export_profiles(profiles, path, "csv")
    back = csv_files.read_profiles(spark, path)
    text = P.prop("properties", "text")
    kind = F.when(text.startswith('"'), "string").otherwise("other")
    return back.where(P.is_list(P.prop("properties", "nested"))).select(
        F.col("distinct_id").cast("bigint").alias("doc_id"),
        kind.alias("kind"),
        F.md5(P.unquoted(text)).alias("text_md5"),
        P.prop_bigint("properties", "n").alias("number"),
        P.prop_boolean("properties", "flag").alias("flag"),
    )


@plan(
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS distinct_id, CAST(CASE WHEN c_acctbal < 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS VARCHAR) AS debt,
  c_name AS name, CASE WHEN c_nationkey < 8 THEN '["' || c_mktsegment || '",' || CAST(c_nationkey AS VARCHAR) || ']' END AS tags
FROM customer
"""
)
def flatten_wide(spark, sf_dir):
    """Sparse maps to a dense table: sorted keys, missing as NULL, nested as JSON."""
    t = D.table(spark, sf_dir, "customer")
    tags = F.concat(
        F.lit("["), P.json_text("c_mktsegment", "string"), F.lit(","), D.text_id("c_nationkey"), F.lit("]")
    )
    sparse = t.select(
        D.text_id("c_custkey").alias("distinct_id"),
        P.props_from_texts(
            {
                "name": P.json_text("c_name", "string"),
                "debt": F.when(F.col("c_acctbal") < 0, D.cents("c_acctbal").cast("string")),
                "tags": F.when(F.col("c_nationkey") < 8, tags),
            }
        ).alias("properties"),
    )
    return X.flatten(sparse, "distinct_id")


@plan(
    """
SELECT kind, format FROM (VALUES ('lines', 'json_lines'), ('packed', 'json_lines'), ('arrays', 'json_array'),
  ('events_csv', 'csv_events'), ('profiles_csv', 'csv_profiles')) AS t(kind, format)
WHERE EXISTS (SELECT 1 FROM events)
"""
)
def detect_format(spark, sf_dir):
    """Formats found in a tree of five kinds of exports."""
    ship_package(spark)
    path = scratch_path(spark, "formats")
    events = cut_lineage(keyed_events(spark, sf_dir))
    X.export_events(events, f"{path}/lines")
    X.export_events(events, f"{path}/packed", compress=True)
    _write_arrays(events, f"{path}/arrays")
    X.export_events(events, f"{path}/events_csv", "csv")
    X.export_profiles(D.customers(spark, sf_dir), f"{path}/profiles_csv", "csv")
    found = detect.detect_formats(spark, path).where(F.col("format") != detect.EMPTY)
    kind = F.regexp_extract("path", "/(lines|packed|arrays|events_csv|profiles_csv)/", 1)
    return found.select(kind.alias("kind"), "format").distinct()


@plan(
    f"""
SELECT event_type AS event, count(*) * 3 AS n, CAST(sum({D.K}) * 3 AS BIGINT) AS k_sum FROM events GROUP BY 1
"""
)
def load_mixed_files(spark, sf_dir):
    """Lines, arrays and CSV side by side in one folder, loaded as one set of events."""
    ship_package(spark)
    path = scratch_path(spark, "mixed")
    events = cut_lineage(keyed_events(spark, sf_dir))
    X.export_events(events, f"{path}/lines")
    _write_arrays(events, f"{path}/arrays")
    X.export_events(events, f"{path}/csv", "csv")
    raw = load.load_events(spark, path)
    return raw.groupBy("event").agg(
        F.count(F.lit(1)).alias("n"), F.sum(P.prop_bigint("properties", "k")).alias("k_sum")
    )


@plan(
    r"""
SELECT md5(line) AS line_md5, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations) GROUP BY 1
"""
)
def raw_copy(spark, sf_dir):
    """All lines of all texts copied unchanged."""
    path = scratch_path(spark, "raw")
    D.table(spark, sf_dir, "conversations").select("text").write.text(f"{path}/in")
    X.copy_raw(spark, f"{path}/in", f"{path}/out")
    copied = spark.read.option("lineSep", "\n").text(f"{path}/out")
    return copied.groupBy(F.md5("value").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- validity, import

GAPS = f"""(SELECT event_id, event_type AS event, {D.K} AS k, {D.EPOCH_S} AS t, user_id,
  event_type = 'error' AND {D.K} < 20 AS no_time, event_type = 'view' AND {D.K} < 10 AS null_time, {D.K} > 90 AS no_user FROM events)"""


@plan(f"SELECT event_id, event, k FROM {GAPS} WHERE no_time OR no_user")
def invalid_events(spark, sf_dir):
    return E.invalid_events(D.raw_with_gaps(spark, sf_dir)).select(
        "event_id", "event", P.prop_bigint("properties", "k").alias("k")
    )


@plan(
    f"""
SELECT event, CAST(user_id AS VARCHAR) AS distinct_id, CASE WHEN null_time THEN NULL ELSE t - 19800 END AS time, k, 'T1' AS token
FROM {GAPS} WHERE NOT (no_time OR no_user)
"""
)
def import_events(spark, sf_dir):
    """Valid events in UTC; an explicit null time passes the check and stays null."""
    out = I.import_events(D.raw_with_gaps(spark, sf_dir).select("event", "properties"), "T1", 5.5)
    return out.select(
        "event",
        "distinct_id",
        "time",
        P.prop_bigint("properties", "k").alias("k"),
        P.prop_string("properties", "token").alias("token"),
    )


@plan(
    f"""
SELECT NOT (no_time OR no_user) AS valid, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum FROM {GAPS} GROUP BY 1
"""
)
def quarantine(spark, sf_dir):
    """Valid and invalid rows written apart from one tagged plan, and read back."""
    path = scratch_path(spark, "split")
    tagged = E.tag_valid(D.raw_with_gaps(spark, sf_dir).select("event", "properties"))
    X.write_split(tagged, f"{path}/valid", f"{path}/invalid")
    good = spark.read.parquet(f"{path}/valid").withColumn("valid", F.lit(True))
    bad = json_files.read_events(spark, f"{path}/invalid").withColumn("valid", F.lit(False))
    return good.unionByName(bad).groupBy("valid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(P.prop_bigint("properties", "k")).alias("k_sum")
    )


# ------------------------------------------------------------- batches, delivery


@plan("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS row_no, (row_number() OVER (ORDER BY event_id) - 1) // 2000 AS batch_no FROM events")
def delivery_batches(spark, sf_dir):
    return BA.number_batches(D.table(spark, sf_dir, "events").select("event_id"), ["event_id"])


@plan(
    """
SELECT batch_no, count(*) AS n_items, to_base64(encode('[' || string_agg(item, ',' ORDER BY c_custkey) || ']')) AS payload
FROM (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 2000 AS batch_no,
  '{"$ignore_time":true,"$ip":0,"$ignore_alias":true,"$token":"T1","$set":{"segment":"' || c_mktsegment || '"},"$distinct_id":"' ||
  CAST(c_custkey AS VARCHAR) || '"}' AS item FROM customer) GROUP BY 1
"""
)
def batch_payload(spark, sf_dir):
    """Update records in numbered batches, as base64 JSON arrays."""
    rows = D.table(spark, sf_dir, "customer").select(
        D.text_id("c_custkey").alias("distinct_id"),
        P.props_from_columns({"segment": ("c_mktsegment", "string")}).alias("value"),
    )
    records = U.update_records(rows, "T1", U.SET, ignore_alias=True).withColumn(
        "key", F.col("distinct_id").cast("bigint")
    )
    return BA.batch_payloads(BA.number_batches(records, ["key"]), "record")


def _refuse_errors(payload: str) -> None:
    """A receiver that turns down batches whose events start with an error."""
    if json.loads(payload)[0]["event"] == "error":
        raise RuntimeError("refused")


@plan(
    f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_no FROM {GAPS} WHERE NOT (no_time OR no_user)),
b AS (SELECT row_no // 2000 AS batch_no, count(*) AS n_items, arg_min(event, row_no) AS head FROM r GROUP BY 1)
SELECT batch_no, n_items, head <> 'error' AS ok, CASE WHEN head = 'error' THEN 'RuntimeError: refused' END AS error FROM b
"""
)
def delivery_results(spark, sf_dir):
    """Event import to a receiver that fails on some batches: every batch has a result."""
    ship_package(spark)
    raw = D.raw_with_gaps(spark, sf_dir)
    results = I.send_events(
        raw, "T1", ["event_id"], _refuse_errors, scratch_path(spark, "results"), 5.5
    )
    return results.select("batch_no", "n_items", "ok", "error")


@plan(
    f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_no FROM {GAPS} WHERE NOT (no_time OR no_user)),
b AS (SELECT row_no // 500 AS batch_no, count(*) AS n_items, arg_min(event, row_no) AS head FROM r GROUP BY 1)
SELECT batch_no, n_items, head <> 'error' AS in_first_run, TRUE AS ok FROM b
"""
)
def delivery_resumed(spark, sf_dir):
    """Batches that a receiver turned down, and no others, are sent again by the next run."""
    delivery = Delivery(spark, scratch_path(spark, "delivery"))
    ready = E.prepare_events(D.raw_with_gaps(spark, sf_dir), "T1", 5.5)
    delivery.prepare(X.event_json(ready, "event_id"), "value", ["event_id"], 500, encode=False)
    first = cut_lineage(delivery.run(_refuse_errors).select("batch_no", F.col("ok").alias("in_first_run")))
    delivery.prepare(X.event_json(ready, "event_id"), "value", ["event_id"], 500, encode=False)
    results = delivery.run(json.loads)
    return results.join(first, "batch_no").select("batch_no", "n_items", "in_first_run", "ok")


def _accept(payload: str) -> None:
    """A receiver that reads the batch and keeps nothing."""
    json.loads(base64.b64decode(payload))


@plan("SELECT CAST(ceil(count(*) / 2000.0) AS BIGINT) AS batches, count(*) AS items FROM customer")
def profile_delivery(spark, sf_dir):
    """All profiles delivered as base64 batches of set records."""
    ship_package(spark)
    results = I.send_profiles(
        D.customers(spark, sf_dir), "T1", _accept, scratch_path(spark, "results")
    )
    return results.where("ok").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("n_items").alias("items")
    )


@plan(
    f"""
SELECT 'after' AS stage, * FROM (SELECT distinct_id, key, CASE WHEN key = 'nation' THEN '0' ELSE value END AS value FROM ({D.CUSTOMER_PROPS}))
WHERE distinct_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'before', * FROM ({D.CUSTOMER_PROPS})
WHERE distinct_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
"""
)
def backup_snapshot(spark, sf_dir):
    """Targets saved before an update, and the same rows after it."""
    people = D.customers(spark, sf_dir)
    targets = U.targets_of(people, Q.equals("properties", "segment", "BUILDING"))
    saved = X.backup(targets, scratch_path(spark, "backup"))
    after = U.set_properties(saved, {"nation": 0})
    stages = [X.long_form(saved, F.lit("before").alias("stage"), "distinct_id")]
    stages.append(X.long_form(after, F.lit("after").alias("stage"), "distinct_id"))
    return stages[0].unionByName(stages[1])


# ---------------------------------------------------------------------- paging


@plan(
    """
SELECT event, CAST(page AS BIGINT) AS page, CAST(page * 500 AS BIGINT) AS first_pos, CAST(least(page * 500 + 500, n) - 1 AS BIGINT) AS last_pos
FROM (SELECT event, n, unnest(generate_series(0, CAST(ceil(n / 500.0) AS BIGINT) - 1)) AS page
  FROM (SELECT event_type AS event, count(*) AS n FROM events GROUP BY 1))
"""
)
def page_plan(spark, sf_dir):
    """Pages of 500 over each event name's items."""
    totals = D.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("event")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return paged.with_pages(totals, "n", 500).select("event", "page", "first_pos", "last_pos")


def write_pages(profiles: DataFrame, path: str, page_size: int) -> int:
    """Profiles as JSON pages, a folder each; returns how many profiles there are."""
    item = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("$distinct_id"), F.struct(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("$properties")))
    numbered = BA.number_batches(profiles.select("c_custkey", item.alias("item")), ["c_custkey"], page_size, "page")
    pages = BA.batch_payloads(numbered, "item", encode=False, batch="page")
    pages.select("page", "payload").write.partitionBy("page").text(path)
    return profiles.count()


def page_service(path: str, page_size: int, total: int):
    """A page service over written pages; each request reads its own page only."""

    def fetch(params: Mapping[str, Any]) -> Mapping[str, Any]:
        page, results = int(params.get("page", 0)), []
        for file in list_folder(f"{path}/page={page}") if total else []:
            with open_file(file) as raw:
                results += json.loads(raw.read())
        return {
            "results": results, "session_id": "s1", "page": page, "page_size": page_size, "total": total
        }

    return fetch


@plan(f"SELECT * FROM ({D.CUSTOMER_PROPS}) WHERE key IN ('name', 'segment')")
def paged_profiles(spark, sf_dir):
    """All profiles through a paged source, one task per page."""
    ship_package(spark)
    path = scratch_path(spark, "pages")
    total = write_pages(D.table(spark, sf_dir, "customer"), path, 1000)
    pages = paged.read_pages(spark, page_service(path, 1000, total))
    return X.long_form(paged.profiles_of_pages(pages), "distinct_id")


# ------------------------------------------------------------------- user queries


@plan(
    f"""
SELECT event_type AS event, count(*) AS n FROM events JOIN customer ON c_custkey = user_id
WHERE c_mktsegment = 'MACHINERY' AND {D.EPOCH_S} >= epoch(TIMESTAMP '2024-01-10') GROUP BY 1
"""
)
def user_query(spark, sf_dir):
    """A user's own SQL with parameters over the registered views."""
    load.register_views(D.events(spark, sf_dir), D.customers(spark, sf_dir))
    return load.run_query(
        spark,
        """SELECT e.event, count(*) AS n FROM events e JOIN profiles p USING (distinct_id)
           WHERE try_element_at(p.properties, 'segment') = to_json(CAST(:segment AS VARIANT))
             AND e.time >= :since GROUP BY e.event""",
        {"segment": "MACHINERY", "since": T.epoch_of("2024-01-10")},
    )


@plan("SELECT CAST(event_id AS BIGINT) AS event_id, event_type FROM events")
def zip_archive(spark, sf_dir):
    """Vendor records packed into zip archives of gzipped lines, and read member by member."""
    ship_package(spark)
    path = scratch_path(spark, "zip")
    lines = D.vendor_records(spark, sf_dir).select("record")
    write_archives(lines, path)
    records = archive.read_zip_records(spark, path)
    return records.select(
        F.regexp_extract(F.get_json_object("record", "$['$insert_id']"), "ev:([0-9]+)_", 1)
        .cast("bigint")
        .alias("event_id"),
        F.get_json_object("record", "$.event_type").alias("event_type"),
    )


def write_archives(lines: DataFrame, path: str) -> None:
    """One archive per partition with one gzipped member, written as a stream."""

    def pack(frames):
        part = TaskContext.get().partitionId()
        with create_file(f"{path}/part-{part}.zip") as sink, zipfile.ZipFile(sink, "w") as z:
            with z.open(f"export/part-{part}.json.gz", "w") as member, gzip.open(member, "wb") as out:
                for frame in frames:
                    out.write("".join(f"{r}\n" for r in frame["record"]).encode())
        yield pd.DataFrame({"part": [part]})

    lines.mapInPandas(pack, "part bigint").write.format("noop").mode("overwrite").save()
