"""Migrating raw Amplitude exports into the event and profile model.

One read gives records; events, profiles and identity merges are three
projections of it. Times without a zone are read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import properties as P
from ..functions import times as T
from ..functions.text import clean_insert_id, first_truthy, is_truthy_json
from .updates import latest_properties

# Source field -> property name.
RENAMED = {
    "app_version": "$app_version_string",
    "os_name": "$os",
    "os_version": "$os_version",
    "device_brand": "$brand",
    "device_manufacturer": "$manufacturer",
    "device_model": "$model",
    "carrier": "$carrier",
    "region": "$region",
    "city": "$city",
    "insert_id": "$insert_id",
    "$insert_id": "$insert_id",
    "platform": "platform",
    "dma": "dma",
    "language": "language",
    "price": "price",
    "quantity": "quantity",
    "revenue": "revenue",
    "productId": "productId",
    "revenueType": "revenueType",
    "location_lat": "location_lat",
    "location_lng": "location_lng",
    "idfa": "idfa",
    "idfv": "idfv",
    "adid": "adid",
    "android_id": "android_id",
    "event_id": "event_id",
    "session_id": "session_id",
    "plan": "plan",
}

INSERT_ID = "$insert_id"
MERGE_EVENT = "$merge"


def parse_records(lines: DataFrame, column: str = "record") -> DataFrame:
    """Lines of JSON text to typed records.

    ``fields`` keeps the fields of the fixed table as JSON text, so that a field
    that is there but null can be told from one that is not there. Others are
    dropped before they are turned into text.
    """
    # Through a generator, which filters on a record's parts are not pushed across:
    # each record is parsed once, whatever is asked of it later.
    parsed = lines.select(
        F.explode_outer(F.array(F.from_json(column, "map<string,variant>"))).alias("_r")
    )

    def text(name: str) -> Column:
        return F.try_variant_get(F.try_element_at("_r", F.lit(name)), "$", "string").alias(name)

    def truthy(name: str) -> Column:
        # Asked of the JSON text, in which the string "0" keeps its quotes.
        return is_truthy_json(F.to_json(F.try_element_at("_r", F.lit(name)))).alias(f"has_{name}")

    def nested(name: str) -> Column:
        inner = F.try_variant_get(
            F.try_element_at("_r", F.lit(name)), "$", "map<string,variant>"
        )
        return P.props_from_variants(inner).alias(name)

    known = F.map_filter("_r", lambda k, _: k.isin(list(RENAMED)))
    return parsed.select(
        text("event_type"),
        text("event_time"),
        text("user_id"),
        text("device_id"),
        text("amplitude_id"),
        truthy("user_id"),
        truthy("device_id"),
        truthy("amplitude_id"),
        F.to_json(F.try_element_at("_r", F.lit("ip_address"))).alias("ip_address"),
        F.to_json(F.try_element_at("_r", F.lit("country"))).alias("country"),
        nested("event_properties"),
        nested("user_properties"),
        P.props_from_variants(known).alias("fields"),
    )


def renamed_fields(fields: Column | str = "fields") -> Column:
    """Fields of the fixed table under their property names; others are dropped.

    Null values are kept. Where both spellings of the insert id are there,
    ``$insert_id`` wins.
    """
    return P.rename_props(fields, RENAMED)


def _with_clean_insert_id(m: Column) -> Column:
    clean = P.json_text(clean_insert_id(P.prop_string(m, INSERT_ID)), "string")
    return F.transform_values(
        m, lambda k, v: F.when(k == INSERT_ID, F.coalesce(clean, F.lit("null"))).otherwise(v)
    )


def _text_or_null(c: Column) -> Column:
    return F.coalesce(P.json_text(c, "string"), F.lit("null"))


_IDS = [(name, f"has_{name}") for name in ("user_id", "device_id", "amplitude_id")]


def event_user() -> Column:
    """User id, else device id, else the vendor's own id."""
    return first_truthy(*_IDS)


def transform_events(records: DataFrame, identity_v3: bool = False) -> DataFrame:
    """Records to events of the model (``time`` in seconds), with ``time_ms`` beside it.

    Envelope properties first, then the record's event properties, then the
    renamed fields; the rightmost wins. ``identity_v3`` adds ``source`` and
    ``$user_id``.
    """
    envelope = {
        "$device_id": _text_or_null(F.col("device_id")),
        "ip": F.coalesce("ip_address", F.lit("null")),
        "mp_country_code": F.coalesce("country", F.lit("null")),
    }
    if identity_v3:
        own = (P.prop_string("user_properties", "user_id"), is_truthy_json(P.prop("user_properties", "user_id")))
        user = first_truthy(_IDS[0], own, *_IDS[1:])
        envelope["source"] = F.lit('"amplitude"')
        envelope["$user_id"] = _text_or_null(user)
    base = F.create_map(*[x for k, v in envelope.items() for x in (F.lit(k), v)])
    # Projected in steps, so that the renamed map is computed once.
    staged = records.withColumn("_renamed", renamed_fields())
    staged = staged.withColumn("_renamed", _with_clean_insert_id(F.col("_renamed")))
    return staged.select(
        F.col("event_type").alias("event"),
        event_user().alias("distinct_id"),
        T.epoch_s(T.parse_export_time("event_time")).alias("time"),
        T.epoch_ms(T.parse_export_time("event_time")).alias("time_ms"),
        P.overlay_all(base, "event_properties", "_renamed").alias("properties"),
    )


def transform_profiles(records: DataFrame) -> DataFrame:
    """One profile row per record with user properties, with ``time_ms`` of the event.

    Renamed fields win over user properties of the same name; ``Name`` also
    becomes ``$name`` unless it is empty.
    """
    name = P.prop("user_properties", "Name")
    truthy = F.coalesce(~name.isin("null", "false", "0", '""', "[]", "{}"), F.lit(False))
    named = F.when(truthy, F.create_map(F.lit("$name"), name)).otherwise(P.empty_props())
    return records.where(F.size("user_properties") > 0).select(
        F.col("user_id").alias("distinct_id"),
        T.epoch_ms(T.parse_export_time("event_time")).alias("time_ms"),
        P.overlay_all("user_properties", renamed_fields(), named).alias("properties"),
    )


def fold_profiles(profile_rows: DataFrame) -> DataFrame:
    """One profile per id: per property the value of the latest event wins.

    Values of the same moment are told apart by their text. Rows without an id
    belong to no profile; an empty id, or the number 0, is an id like any other
    here, as the source writes profiles by whatever the field holds.
    """
    return latest_properties(profile_rows, "time_ms")


def merge_pairs(records: DataFrame, distinct: bool = True) -> DataFrame:
    """``id_a, id_b``: user id and vendor id of records that have both.

    Over the whole input each pair comes once, unless ``distinct`` is off.
    """
    pairs = records.where(F.col("has_user_id") & F.col("has_amplitude_id")).select(
        F.col("user_id").alias("id_a"), F.col("amplitude_id").alias("id_b")
    )
    return pairs.dropDuplicates(["id_a", "id_b"]) if distinct else pairs


def merge_events(pairs: DataFrame, time_ms: int) -> DataFrame:
    """Identity-merge events of pairs; the time is the caller's, so runs repeat."""
    ids = P.close_list(F.array(P.json_text("id_a", "string"), P.json_text("id_b", "string")))
    return pairs.select(
        F.lit(MERGE_EVENT).alias("event"),
        F.lit("").alias("distinct_id"),
        F.lit(time_ms // 1000).cast("bigint").alias("time"),
        F.lit(time_ms).cast("bigint").alias("time_ms"),
        F.create_map(F.lit("$distinct_ids"), ids).alias("properties"),
    )


def migrate(
    records: DataFrame, merge_time_ms: int, identity_v3: bool = False
) -> dict[str, DataFrame]:
    """Profiles (folded) and events (with identity merges) of one export.

    The merges of ``identity_v3`` are not reduced to distinct pairs.
    """
    pairs = merge_pairs(records, distinct=not identity_v3)
    events = transform_events(records, identity_v3)
    return {
        "profiles": fold_profiles(transform_profiles(records)),
        "events": events.unionByName(merge_events(pairs, merge_time_ms)),
    }
