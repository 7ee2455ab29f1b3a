"""Queries over feeds: the batch operators run to completion on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import properties as P
from ..session import cut_lineage, scratch_path
from ..sinks import exports as X
from ..sources import json_files
from ..streaming import feeds as S
from ..streaming.profile_store import ProfileStore
from . import files, tables as D
from .registry import plan


def _feed(spark, sf_dir, name: str) -> DataFrame:
    """A test table as a stream, be it one file or a folder of files."""
    schema = D.table(spark, sf_dir, name).schema
    # As a pattern, since a stream takes no path of a single file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def _drain(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything there is and read what it wrote."""
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        # With complete output the last batch holds the whole result.
        target = f"{path}/out" if mode == "complete" else f"{path}/out/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    query = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


@plan(
    f"""
SELECT NOT (no_time OR no_user) AS valid, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum,
  CAST(sum(CASE WHEN no_time OR no_user OR null_time THEN 0 ELSE t + 28800 END) AS BIGINT) AS time_sum
FROM {files.GAPS} GROUP BY 1
"""
)
def stream_ingest(spark, sf_dir):
    """Raw events arriving as files: valid ones in UTC, the others set aside."""
    path = scratch_path(spark, "ingest")
    X.write_json(
        X.event_json(D.raw_with_gaps(spark, sf_dir).select("event", "properties")), f"{path}/in"
    )
    feed = S.read_event_feed(spark, f"{path}/in")
    S.ingest(
        feed, "T1", -8, f"{path}/events", f"{path}/invalid", f"{path}/checkpoint", once=True
    ).awaitTermination()
    good = spark.read.parquet(f"{path}/events").select(
        F.lit(True).alias("valid"), "properties", F.coalesce("time", F.lit(0)).alias("time")
    )
    bad = json_files.read_events(spark, f"{path}/invalid/*").select(
        F.lit(False).alias("valid"), "properties", F.lit(0).cast("bigint").alias("time")
    )
    return good.unionByName(bad).groupBy("valid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(P.prop_bigint("properties", "k")).alias("k_sum"),
        F.sum("time").alias("time_sum"),
    )


@plan(
    f"""
SELECT {D.EPOCH_S} - {D.EPOCH_S} % 86400 AS day_start, event_type AS event, count(*) AS n FROM events GROUP BY 1, 2
"""
)
def stream_counts(spark, sf_dir):
    """Events per name and day over a feed."""
    events = S.with_event_time(D.shaped(_feed(spark, sf_dir, "events")))
    counted = S.windowed_counts(events)
    out = _drain(counted, scratch_path(spark, "counts"), "complete")
    return out.select(F.unix_timestamp("window_start").alias("day_start"), "event", "n")


@plan(
    """
SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) AS id_a, CAST(user_id + 1000 AS VARCHAR) AS id_b FROM events
WHERE user_id IS NOT NULL
"""
)
def stream_merges_all(spark, sf_dir):
    """Identity pairs of every user of a feed of two files, each once whenever it comes."""
    path = scratch_path(spark, "merges")
    events = D.table(spark, sf_dir, "events").where("user_id IS NOT NULL").select("user_id", "ts")
    # The same users in two files, one after the other, so that pairs come again in a later batch.
    for half in (F.col("ts"), F.col("ts") + F.expr("INTERVAL 1 YEAR")):
        events.withColumn("ts", half).coalesce(1).write.mode("append").parquet(f"{path}/in")
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    user = F.col("user_id")
    pairs = feed.select(
        F.concat(F.lit("u"), user.cast("string")).alias("id_a"),
        (user + 1000).cast("string").alias("id_b"),
        F.col("ts").cast("timestamp").alias("event_time"),
    ).withWatermark("event_time", "60 days")
    S.first_merges(pairs, f"{path}/index", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/index").select("id_a", "id_b")


@plan(
    f"""
SELECT {D.UID} AS distinct_id,
  CAST(count(*) FILTER (WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-19') AS BIGINT) AS bought,
  CAST(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-06') AS BIGINT) AS seen
FROM events WHERE ts < TIMESTAMP '2024-01-26' GROUP BY 1
"""
)
def stream_behaviors(spark, sf_dir):
    """Daily counts per user from a feed, summed to trailing windows of 7 and 20 days."""
    wanted = [
        {"window": "7d", "name": "bought", "event_selectors": ["purchase"]},
        {"window": "20d", "name": "seen"},
    ]
    events = S.with_event_time(D.shaped(_feed(spark, sf_dir, "events")))
    daily = _drain(
        S.daily_behavior_counts(events, wanted), scratch_path(spark, "days"), "complete"
    )
    return S.behaviors_from_days(daily, wanted, "2024-01-25")


@plan(
    f"""
WITH e AS (SELECT {D.UID} AS distinct_id, event_type, {D.EPOCH_S} AS time FROM events)
SELECT distinct_id,
  CAST(count(*) FILTER (WHERE event_type = 'purchase' AND time > 1706187600 - 7 * 86400) AS BIGINT) AS bought,
  CAST(count(*) FILTER (WHERE time > 1706187600 - 20 * 86400) AS BIGINT) AS seen,
  CAST(count(*) FILTER (WHERE time > 1706187600 - 5 * 3600) AS BIGINT) AS lately
FROM e WHERE time > 1706187600 - 20 * 86400 AND time <= 1706187600 GROUP BY 1
"""
)
def behaviors_from_buckets(spark, sf_dir):
    """Trailing windows that end at 13:00, from daily counts of a feed and the rows of the days at their edges."""
    wanted = [
        {"window": "7d", "name": "bought", "event_selectors": ["purchase"]},
        {"window": "20d", "name": "seen"},
        {"window": "5h", "name": "lately"},
    ]
    feed = S.with_event_time(D.shaped(_feed(spark, sf_dir, "events")))
    daily = _drain(S.daily_behavior_counts(feed, wanted), scratch_path(spark, "days"), "complete")
    return S.behaviors_at(daily, D.events(spark, sf_dir), wanted, 1706187600)


@plan(
    f"""
WITH c AS (SELECT {D.UID} AS distinct_id, CAST(count(*) AS VARCHAR) AS n, arg_max(event_type, event_id) AS last FROM events GROUP BY 1)
SELECT * FROM ({D.CUSTOMER_PROPS})
UNION ALL SELECT distinct_id, 'events', n FROM c
UNION ALL SELECT distinct_id, 'last_event', '"' || last || '"' FROM c
"""
)
def stream_updates(spark, sf_dir):
    """Every event of a feed of ten files as two updates of its user's profile, in a store."""
    path = scratch_path(spark, "updates")
    store = ProfileStore(spark, f"{path}/profiles", buckets=8)
    store.create(D.customers(spark, sf_dir))
    events = D.table(spark, sf_dir, "events")
    parts = cut_lineage(events.repartitionByRange(10, "event_id").withColumn("part", F.spark_partition_id()))
    # One after another, as files arrive: a feed takes them by their time.
    for part in range(10):
        parts.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{path}/events")
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
    ops = F.array(
        F.struct(
            F.lit("$add").alias("op"),
            F.create_map(F.lit("events"), F.lit("1")).alias("payload"),
            (F.col("event_id") * 2).alias("seq"),
        ),
        F.struct(
            F.lit("$set").alias("op"),
            F.create_map(F.lit("last_event"), P.json_text("event_type", "string")).alias("payload"),
            (F.col("event_id") * 2 + 1).alias("seq"),
        ),
    )
    updates = feed.select(D.text_id("user_id").alias("distinct_id"), F.explode_outer(ops).alias("u")).select(
        "distinct_id", "u.seq", "u.op", "u.payload"
    )
    S.update_profiles(updates, store, f"{path}/checkpoint", once=True).awaitTermination()
    return X.long_form(store.read(), "distinct_id")
