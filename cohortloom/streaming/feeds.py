"""Streaming forms of the batch operators, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import predicates as Q
from ..functions import properties as P
from ..operators import events as E
from ..operators.behaviors import window_seconds
from ..session import child_names, cut_lineage, owned_cuts
from ..sinks.exports import event_json
from ..sources.json_files import EVENT_JSON
from .profile_store import ProfileStore


def read_event_feed(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Raw events from JSON-line files as they arrive in a folder."""
    lines = (
        spark.readStream.schema(EVENT_JSON)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )
    return lines.select("event", P.props_from_variants("properties").alias("properties"))


def _start(df: DataFrame, write, checkpoint: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def ingest(
    raw: DataFrame,
    token: str,
    offset_hours: float,
    events_path: str,
    invalid_path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Write valid events (UTC) to one table and invalid ones to another.

    Each batch has its own folder, overwritten if the batch runs again, so a
    restart leaves no row twice. A batch is parsed once, into a cut that both writes read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with owned_cuts(batch.sparkSession):
            rows = cut_lineage(batch, "ingest")
            good = E.shape_events(E.prepare_events(rows, token, offset_hours))
            good.write.mode("overwrite").parquet(f"{events_path}/batch={batch_id}")
            bad = event_json(E.invalid_events(rows))
            bad.write.mode("overwrite").text(f"{invalid_path}/batch={batch_id}")

    return _start(raw, write, checkpoint, once)


def with_event_time(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Shaped events with a watermarked ``event_time``."""
    return events.withColumn("event_time", F.timestamp_seconds("time")).withWatermark(
        "event_time", late
    )


def windowed_counts(events: DataFrame, window: str = "1 day", by_user: bool = False) -> DataFrame:
    """Counts per event name (and user) and time window, over watermarked events."""
    keys = ["distinct_id", "event"] if by_user else ["event"]
    counted = events.groupBy(F.window("event_time", window).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"
    )


def distinct_merges(pairs: DataFrame) -> DataFrame:
    """Each ``id_a, id_b`` pair once while it is within the watermark."""
    return pairs.dropDuplicatesWithinWatermark(["id_a", "id_b"])


def first_merges(
    pairs: DataFrame, index_path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write each ``id_a, id_b`` pair of a feed once, however long after the first it comes again.

    Watermarked state drops what repeats within the watermark. What is left is
    held against an index of all pairs written before, which is the table under ``index_path``
    itself, a folder per batch. Of the index only the pairs that the batch has are
    sought, so it is scanned but, for a batch Spark can broadcast, not shuffled. A batch that runs
    again sees the folders before its own and replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, keys = batch.sparkSession, ["id_a", "id_b"]
        named = [n for n in child_names(spark, index_path) if n.startswith("batch=")]
        before = [f"{index_path}/{n}" for n in named if int(n.split("=")[1]) < batch_id]
        fresh = batch.select(*keys).distinct()
        if before:
            fresh = cut_lineage(fresh, "pairs")
            seen = spark.read.schema(fresh.schema).parquet(*before).join(fresh, keys, "left_semi")
            fresh = fresh.join(seen, keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{index_path}/batch={batch_id}")

    def owned(batch: DataFrame, batch_id: int) -> None:
        with owned_cuts(batch.sparkSession):
            write(batch, batch_id)

    return _start(distinct_merges(pairs), owned, checkpoint, once)


def daily_behavior_counts(
    events: DataFrame, behaviors: list[Mapping[str, Any]]
) -> DataFrame:
    """Per user, day and behaviour count columns.

    A trailing window of any length is a sum of these rows, so the state held
    is that of open days only, not of whole windows.
    """
    counts = [
        F.count(F.when(Q.event_is(b.get("event_selectors")), F.lit(1))).alias(b["name"])
        for b in behaviors
    ]
    grouped = events.groupBy(F.window("event_time", "1 day").alias("w"), "distinct_id").agg(*counts)
    names = [b["name"] for b in behaviors]
    return grouped.select(F.to_date("w.start").alias("day"), "distinct_id", *names)


def behaviors_from_days(
    daily: DataFrame, behaviors: list[Mapping[str, Any]], as_of_day: str
) -> DataFrame:
    """Behaviour counts over whole days: the last ``window`` days up to ``as_of_day``."""
    end = F.lit(as_of_day).cast("date")
    sums = [
        F.coalesce(
            F.sum(
                F.when(
                    F.col("day") > F.date_sub(end, max(window_seconds(b["window"]) // 86400, 1)),
                    F.col(b["name"]),
                )
            ),
            F.lit(0),
        ).alias(b["name"])
        for b in behaviors
    ]
    return daily.where(F.col("day") <= end).groupBy("distinct_id").agg(*sums)


def behaviors_at(
    daily: DataFrame, events: DataFrame, behaviors: list[Mapping[str, Any]], as_of: int, offset_hours: float = 0
) -> DataFrame:
    """What :func:`..operators.behaviors.behavior_counts` gives, to the second, from daily sums.

    Whole days inside a window come from ``daily``; of ``events`` only the rows of
    the days are read in which a window begins or ends: the last, and one per length of window.
    """
    end, day = int(as_of + offset_hours * 3600), 86_400
    starts = {b["name"]: end - window_seconds(b["window"]) for b in behaviors}
    time, number = F.col("time"), F.datediff("day", F.lit("1970-01-01").cast("date"))

    def at_edge(start: int) -> Column:
        first_whole, last_whole = (start // day + 1) * day, end // day * day
        if first_whole > last_whole:
            return (time > start) & (time <= end)
        return ((time > start) & (time < first_whole)) | ((time >= last_whole) & (time <= end))

    def inside(start: int) -> Column:
        return (number > start // day) & (number < end // day)

    some = lambda of: reduce(or_, [of(start) for start in set(starts.values())])
    edge_counts = [
        F.count(F.when(at_edge(starts[b["name"]]) & Q.event_is(b.get("event_selectors")), F.lit(1))).alias(b["name"])
        for b in behaviors
    ]
    edges = events.where(some(at_edge)).groupBy("distinct_id").agg(*edge_counts)
    day_sums = [F.coalesce(F.sum(F.when(inside(start), F.col(n))), F.lit(0)).alias(n) for n, start in starts.items()]
    days = daily.where(some(inside)).groupBy("distinct_id").agg(*day_sums)
    return edges.unionByName(days).groupBy("distinct_id").agg(*[F.sum(n).alias(n) for n in starts])


def update_profiles(
    updates: DataFrame,
    store: ProfileStore,
    checkpoint: str,
    once: bool = False,
    compact_at: float | None = 1.0,
) -> StreamingQuery:
    """Apply a feed of ``distinct_id, seq, op, payload`` to a profile store.

    Each batch is folded and written at its own cost. A batch that runs again
    replaces what it wrote, so adds and appends are not applied twice. The
    store is compacted once its deltas have ``compact_at`` times the rows of its base,
    so a profile is rewritten for every so many rows of updates; with ``None`` never.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        opened = ProfileStore(batch.sparkSession, store.path, store.buckets)
        opened.append(batch, batch_id)
        if compact_at is not None and opened.is_due(compact_at):
            opened.compact()

    return _start(updates, write, checkpoint, once)
