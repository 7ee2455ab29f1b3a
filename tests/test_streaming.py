import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortloom.operators import folding
from cohortloom.operators.behaviors import behavior_counts
from cohortloom.session import cut_lineage, shared_dir
from cohortloom.streaming import feeds as S
from cohortloom.streaming.profile_store import ProfileStore


UPDATES = "distinct_id string, seq bigint, op string, payload map<string,string>"


def test_update_feed_survives_a_restart(spark, profiles_of, as_dict, tmp_path):
    """Batches of adds over two runs count every file once."""
    feed = tmp_path / "feed"
    store = ProfileStore(spark, str(tmp_path / "profiles"), buckets=4)
    store.create(profiles_of({"a": {"n": 1}}))

    def arrive(seq):
        rows = [("a", seq, "$add", {"n": "10"}), ("b", seq, "$append", {"l": str(seq)})]
        spark.createDataFrame(rows, UPDATES).coalesce(1).write.mode("append").parquet(str(feed))

    def run():
        updates = spark.readStream.schema(UPDATES).parquet(str(feed))
        S.update_profiles(updates, store, str(tmp_path / "cp"), once=True).awaitTermination()

    arrive(1)
    run()
    run()
    arrive(2)
    run()
    assert as_dict(store.read()) == {"a": {"n": 21}, "b": {"l": [1, 2]}}


def random_batches(rng, n_batches, n_updates):
    """Batches of updates of few ids and names, so that all kinds meet; ``seq`` starts anew in each."""
    values = ["1", "2.5", '"x"', "[1,2]", '["x"]', "null", "[]"]
    batches = []
    for _ in range(n_batches):
        rows = []
        for seq in rng.permutation(n_updates).tolist():
            op = rng.choice(["$set", "$set_once", "$add", "$append", "$union", "$remove", "$unset", "$delete"], p=[.2, .15, .15, .15, .1, .1, .1, .05])
            value = {"$add": "1.5", "$union": rng.choice(["[1,3]", '["x",1]', "[]"])}.get(op, rng.choice(values))
            payload = None if op == "$delete" else {str(rng.choice(["p", "q"])): str(value)}
            rows.append((str(rng.choice(["a", "b", "c", "d"])), int(seq), str(op), payload))
        batches.append(rows)
    return batches


@pytest.mark.parametrize("compact_after", [(), (4,), (0, 1, 6, 9)])
def test_a_store_holds_what_applying_each_batch_gives(spark, profiles_of, as_dict, tmp_path, compact_after):
    start = profiles_of({"a": {"p": 1, "q": [1]}, "b": {"p": "x"}, "z": {"q": 7}})
    store = ProfileStore(spark, str(tmp_path / "profiles"), buckets=3)
    store.create(start)
    want = start
    for n, rows in enumerate(random_batches(np.random.default_rng(len(compact_after)), 10, 14)):
        batch = spark.createDataFrame(rows, UPDATES)
        want = cut_lineage(folding.apply_updates(want, batch))
        store.append(batch, n)
        if n == 5:
            store.append(batch, n)
        if n in compact_after:
            store.compact()
            store.append(batch, n)
    assert as_dict(store.read()) == as_dict(want)
    some = spark.createDataFrame([("a",), ("z",), ("none",)], "distinct_id string")
    assert as_dict(store.read(some)) == {k: v for k, v in as_dict(want).items() if k in ("a", "z")}


def test_a_batch_writes_what_it_touches_and_half_written_folders_do_not_count(spark, profiles_of, as_dict, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profiles"), buckets=4)
    store.create(profiles_of({str(i): {"n": 1} for i in range(500)}))
    for n in range(3):
        rows = [("7", 0, "$add", {"n": "1"}), ("new", 0, "$set", {"n": str(n)})]
        store.append(spark.createDataFrame(rows, UPDATES), n)
    delta = tmp_path / "profiles" / "delta"
    assert spark.read.parquet(str(delta)).count() == 6
    assert not store.is_due(0.5) and store.is_due(0.01)
    (delta / "batch=2" / "_SUCCESS").unlink()
    assert as_dict(store.read())["7"] == {"n": 3}
    store.append(spark.createDataFrame([("7", 0, "$add", {"n": "5"})], UPDATES), 2)
    store.compact()
    store.compact()
    assert as_dict(store.read())["7"] == {"n": 8} and as_dict(store.read())["new"] == {"n": 1}
    assert store.read().count() == 501 and not store.is_due(0.0)


def test_cuts_of_a_batch_go_with_it(spark, profiles_of, tmp_path):
    before = set(os.listdir(shared_dir(spark)))
    store = ProfileStore(spark, str(tmp_path / "profiles"), buckets=4)
    store.create(profiles_of({"a": {"n": 1}}))
    store.append(spark.createDataFrame([("a", 0, "$add", {"n": "1"})], UPDATES), 0)
    assert set(os.listdir(shared_dir(spark))) == before


def test_ingest_quarantines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [
        {"event": "e", "properties": {"distinct_id": "a", "time": 3600}},
        {"event": "e", "properties": {"distinct_id": "a"}},
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    feed = S.read_event_feed(spark, str(tmp_path / "in"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    S.ingest(feed, "T", 1, good, bad, str(tmp_path / "cp"), once=True).awaitTermination()
    assert [r["time"] for r in spark.read.parquet(good).collect()] == [0]
    assert spark.read.text(f"{bad}/*").count() == 1


def test_late_pairs_are_dropped_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1", 0), ("a", "1", 5), ("b", "2", 6)], "id_a string, id_b string, t bigint")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    timed = stream.withColumn("event_time", F.timestamp_seconds("t")).withWatermark("event_time", "1 hour")
    query = (
        S.distinct_merges(timed)
        .writeStream.format("memory").queryName("pairs").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination()
    assert spark.table("pairs").count() == 2


def test_a_pair_that_comes_again_after_a_year_is_written_once(spark, tmp_path):
    schema, year = "id_a string, id_b string, t bigint", 366 * 86_400
    index, feed = str(tmp_path / "index"), str(tmp_path / "in")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)

    def run(checkpoint="cp"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
        timed = stream.withColumn("event_time", F.timestamp_seconds("t")).withWatermark("event_time", "1 hour")
        S.first_merges(timed, index, str(tmp_path / checkpoint), once=True).awaitTermination()

    arrive([("a", "1", 0), ("a", "1", 5), ("b", "2", 6)])
    run()
    arrive([("c", "3", year)])
    arrive([("a", "1", year + 7200), ("d", "4", year + 7200)])
    run()
    arrive([("d", "4", 3 * year), ("b", "2", 3 * year), ("e", "5", 3 * year)])
    run()
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(index).select("id_a", "id_b").collect())
    assert got == [("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "5")]
    run("lost checkpoint")
    again = sorted(tuple(r) for r in spark.read.parquet(index).select("id_a", "id_b").collect())
    assert again == got


def test_merges_of_every_user_of_a_feed(spark):
    sf = "/root/testdata/sf0.001"
    users = {r[0] for r in spark.read.parquet(f"{sf}/events.parquet").select("user_id").distinct().collect()} - {None}
    assert any(u % 3 == 0 for u in users)
    found = [tuple(r) for r in entry.queries()["stream_merges_all"](spark, sf).collect()]
    assert sorted(found) == sorted((f"u{u}", str(u + 1000)) for u in users)


def test_user_windows(spark, tmp_path):
    rows = [("e", "a", 10), ("e", "a", 20), ("e", "b", 86_410)]
    events = spark.createDataFrame(rows, "event string, distinct_id string, time bigint")
    counted = S.windowed_counts(S.with_event_time(events), by_user=True)
    got = {(r["distinct_id"], r["n"]) for r in counted.collect()}
    assert got == {("a", 2), ("b", 1)}


@pytest.mark.parametrize("as_of,offset", [(10 * 86_400 + 46_800, 0), (10 * 86_400, 0), (10 * 86_400 - 1, 0), (10 * 86_400 + 100, 5.5)])
def test_windows_from_days_and_edges_are_exact(spark, as_of, offset):
    rng = np.random.default_rng(1)
    edges = [d * 86_400 + s for d in range(12) for s in (-1, 0, 1)] + [as_of + int(offset * 3600) - w + s for w in (3600, 86_400, 3 * 86_400, 100_000) for s in (-1, 0, 1)]
    times = [*rng.integers(0, 12 * 86_400, 400).tolist(), *edges]
    rows = [(str(rng.choice(["e", "f"])), str(rng.choice(["a", "b", "c"])), int(t)) for t in times] + [("e", "old", 5)]
    events = spark.createDataFrame(rows, "event string, distinct_id string, time bigint")
    wanted = [{"window": "1h", "name": "n_hour"}, {"window": "1d", "name": "n_day", "event_selectors": ["e"]},
              {"window": "3d", "name": "n_days"}, {"window": "100000s", "name": "odd"}]
    daily = S.daily_behavior_counts(S.with_event_time(events), wanted)
    order = ["distinct_id", *(b["name"] for b in wanted)]
    got = sorted(tuple(r) for r in S.behaviors_at(daily, events, wanted, as_of, offset).select(*order).collect())
    assert got == sorted(tuple(r) for r in behavior_counts(events, wanted, as_of, offset).select(*order).collect())
