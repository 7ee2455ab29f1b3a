import gzip
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortloom.operators import batches as BA
from cohortloom.operators.events import shape_events
from cohortloom.sinks import delivery, exports as X
from cohortloom.sources import archive, csv_files, detect, json_files, load, paged


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(path)


EVENT = '{"event":"e","properties":{"distinct_id":"a","time":5,"k":1.0}}'


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "a.json.gz", f"{EVENT}\n{EVENT}\n")
    rows = shape_events(json_files.read_events(spark, path)).collect()
    assert [(r["distinct_id"], r["time"], r["properties"]) for r in rows] == [("a", 5, {"k": "1"})] * 2
    bad = write(tmp_path / "b.json", f"{EVENT}\n{{broken\n")
    with pytest.raises(Exception):
        json_files.read_events(spark, bad).collect()
    kept = json_files.read_events(spark, bad, fail_fast=False).cache()
    assert kept.where("_corrupt_record IS NOT NULL").count() == 1


def test_json_array_and_single_object(spark, tmp_path):
    path = write(tmp_path / "a.json", f"[{EVENT},\n{EVENT}]")
    assert json_files.read_events(spark, path, whole_file=True).count() == 2
    one = write(tmp_path / "b.json", '{"event":"e",\n"properties":{"time":1}}')
    assert json_files.read_events(spark, one, whole_file=True).count() == 1


def test_csv_rows(spark, tmp_path):
    text = 'event,distinct_id,time,k,note\ne,007,5,1.0,"two\nlines, ""q"""\ne,b,6\n'
    rows = csv_files.read_events(spark, write(tmp_path / "a.csv", text)).collect()
    assert rows[0]["distinct_id"] == "007"
    assert rows[0]["properties"] == {"k": "1", "note": json.dumps('two\nlines, "q"')}
    assert rows[1]["properties"] == {}
    people = csv_files.read_profiles(spark, write(tmp_path / "b.csv", "$distinct_id,n\n12,true\n"))
    assert people.first() == ("12", {"n": "true"})
    with pytest.raises(ValueError):
        csv_files.read_events(spark, write(tmp_path / "c.csv", "event,time\ne,1\n"))


def test_detection(spark, tmp_path):
    expected = {
        "a.json": ("\n\n [1]", detect.JSON_ARRAY),
        "b.json": (EVENT, detect.JSON_LINES),
        "c.json.gz": (EVENT, detect.JSON_LINES),
        "d.csv": ("time,event,distinct_id\n", detect.CSV_EVENTS),
        "e.csv": ('"$distinct_id","x"\n', detect.CSV_PROFILES),
        "f.txt": ("hello\n", detect.UNKNOWN),
        "g space.csv": ("event,distinct_id,time\n", detect.CSV_EVENTS),
        "h.json": ("\n \n", detect.EMPTY),
    }
    for name, (text, _) in expected.items():
        write(tmp_path / "in" / name, text)
    found = detect.detect_formats(spark, str(tmp_path / "in")).collect()
    got = {r["path"].rsplit("/", 1)[1]: r["format"] for r in found}
    assert got == {name: kind for name, (_, kind) in expected.items()}


def test_loading_any_source(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder / "a.json", EVENT + "\n")
    write(folder / "b.json", f"[{EVENT}]")
    write(folder / "c.csv", "event,distinct_id,time,k\ne,a,5,1\n")
    write(folder / "d.csv", "event,distinct_id,time,other\ne,a,5,1\n")
    assert load.load_events(spark, str(folder)).count() == 4
    listed = load.load_events(spark, [json.loads(EVENT)])
    assert listed.first()["properties"] == {"distinct_id": '"a"', "time": "5", "k": "1"}
    people = load.load_profiles(spark, [{"$distinct_id": 5, "$properties": {"a": None}}])
    assert people.first() == ("5", {"a": "null"})
    assert load.load_profiles(spark, people) is people
    with pytest.raises(TypeError):
        load.load_events(spark, 5)


def test_csv_round_trip(spark, profiles_of, as_dict, tmp_path):
    people = {"a": {"s": "x", "n": 1.5, "b": True, "l": [1, "y"]}, "b": {"other": {"k": 1}}, "c": {}}
    X.export_profiles(profiles_of(people), str(tmp_path / "out"), "csv")
    assert as_dict(csv_files.read_profiles(spark, str(tmp_path / "out"))) == people
    with pytest.raises(ValueError):
        X.export_profiles(profiles_of(people), str(tmp_path / "x"), "xml")


def test_profile_json_round_trip(spark, profiles_of, as_dict, tmp_path):
    people = {"a": {"s": 'q"', "n": None}, "b": {"l": [1, {"k": "v"}]}}
    X.export_profiles(profiles_of(people), str(tmp_path / "out"), compress=True)
    assert as_dict(json_files.read_profiles(spark, str(tmp_path / "out"))) == people


@pytest.mark.parametrize("n, expected", [(0, []), (1, [1]), (4, [4]), (5, [4, 1]), (9, [4, 4, 1])])
def test_batch_sizes(spark, n, expected):
    rows = spark.range(n).repartition(3)
    numbered = BA.number_batches(rows, ["id"], 4)
    sizes = numbered.groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in sizes] == expected
    assert numbered.where(F.col("row_no") != F.col("id")).count() == 0


def test_payload_is_one_line_of_base64(spark):
    import base64

    rows = spark.range(100).select("id", F.col("id").cast("string").alias("item"))
    payload = BA.batch_payloads(BA.number_batches(rows, ["id"], 100), "item").first()["payload"]
    assert "\n" not in payload and json.loads(base64.b64decode(payload)) == list(range(100))


def test_failed_batches_are_kept(spark, tmp_path):
    rows = spark.range(10).select("id", F.col("id").cast("string").alias("item"))

    def send(payload):
        if "5" in payload:
            raise TimeoutError("slow")

    results = delivery.deliver(rows, "item", ["id"], send, str(tmp_path / "r"), 4, encode=False)
    got = {r["batch_no"]: (r["n_items"], r["ok"]) for r in results.collect()}
    assert got == {0: (4, True), 1: (4, False), 2: (2, True)}
    failed = delivery.failed_batches(results).collect()
    assert [(r["payload"], r["error"]) for r in failed] == [("[4,5,6,7]", "TimeoutError: slow")]


@pytest.mark.parametrize("total, size", [(0, 3), (3, 3), (7, 3)])
def test_pages(spark, total, size):
    def fetch(params):
        page = params.get("page", 0)
        items = [{"$distinct_id": str(i), "$properties": {"i": i}} for i in range(total)]
        if page:
            assert params["session_id"] == "s" and params["where"] == "w"
        return {
            "results": items[page * size : (page + 1) * size],
            "session_id": "s", "page": page, "page_size": size, "total": total,
        }

    pages = paged.read_pages(spark, fetch, {"where": "w"}).orderBy("page", "pos")
    people = paged.profiles_of_pages(pages).collect()
    assert [r["distinct_id"] for r in people] == [str(i) for i in range(total)]


def test_page_without_results(spark):
    with pytest.raises(Exception, match="no results"):
        paged.read_pages(spark, lambda params: {"error": "x"}).collect()


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for n in range(3):
            z.writestr(f"123/{n}.json.gz", gzip.compress(f'{{"n":{n}}}\n{{"n":{n}}}\n'.encode()))
        z.writestr("123/readme.txt", "no")
    lines = archive.read_zip_records(spark, str(tmp_path))
    got = sorted(r["record"] for r in lines.collect())
    assert got == sorted([f'{{"n":{n}}}' for n in range(3)] * 2)


def test_groups_of_every_type_come_back_from_csv(spark):
    rows = entry.queries()["csv_groups_all"](spark, "/root/testdata/sf0.001").collect()
    assert {r["group_type"] for r in rows} == {"nations", "suppliers"}


def test_csv_appended_with_other_names(spark, profiles_of, as_dict, tmp_path):
    first = {"a": {"x": 1, "y": "two\nlines"}, "b": {}}
    later = {"c": {"a0": True, "y": 'q"'}, "d": {"z": [1, {"k": None}], "x": None}}
    X.export_profiles(profiles_of(first), str(tmp_path / "out"), "csv")
    X.export_profiles(profiles_of(later), str(tmp_path / "out"), "csv", append=True, compress=True)
    assert as_dict(csv_files.read_profiles(spark, str(tmp_path / "out"))) == {**first, "c": later["c"], "d": {"z": [1, {"k": None}]}}


def test_csv_of_very_many_names(spark, tmp_path):
    n = 20_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("distinct_id"),
        F.create_map(F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 6, "0")), F.lit("1")).alias("properties"),
    ).where("id % 400 = 7")
    wide = rows.unionByName(
        spark.range(1).select(
            F.lit("all").alias("distinct_id"),
            F.map_from_entries(
                F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(F.concat(F.lit("p"), F.lpad(i.cast("string"), 6, "0")), i.cast("string")))
            ).alias("properties"),
        )
    )
    X.export_profiles(wide, str(tmp_path / "out"), "csv")
    back = {r["distinct_id"]: r["properties"] for r in csv_files.read_profiles(spark, str(tmp_path / "out")).collect()}
    assert back["407"] == {"p000407": "1"} and len(back) == 51
    assert back["all"] == {f"p{i:06d}": str(i) for i in range(n)}


def test_groups_of_many_types_in_one_job(spark, tmp_path):
    names = [f"t{i}" for i in range(60)] + ["a/b c%20+d", "é=x"]
    rows = [(t, f"g{i}", {f"k{k % 3}": str(i), "n": '"v"'}) for k, t in enumerate(names) for i in range(3)]
    groups = spark.createDataFrame(rows, "group_type string, group_id string, properties map<string,string>").repartition(3)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    X.export_groups(groups, str(tmp_path / "out"))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before < 12
    back = [(r["group_type"], r["group_id"], r["properties"]) for r in csv_files.read_groups(spark, str(tmp_path / "out")).collect()]
    key = lambda r: r[:2]
    assert sorted(back, key=key) == sorted(rows, key=key)


def test_a_delivery_that_was_killed_goes_on_where_it_was(spark, tmp_path):
    rows = spark.range(400).select("id", F.col("id").cast("string").alias("item"))
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def arrive(payload):
        first = json.loads(payload)[0]
        (inbox / f"{first}-{os.urandom(4).hex()}").touch()

    def die_after_some(payload):
        if len(list(inbox.iterdir())) >= 12:
            raise SystemExit("killed")
        if json.loads(payload)[0] == 20:
            raise TimeoutError("slow")
        arrive(payload)

    made = delivery.Delivery(spark, str(tmp_path / "d"))
    made.prepare(rows, "item", ["id"], 10, encode=False)
    with pytest.raises(Exception):
        made.run(die_after_some)
    arrived = {int(p.name.split("-")[0]) // 10 for p in inbox.iterdir()}
    receipts = {r["batch_no"] for r in made.receipts().collect()}
    assert 12 <= len(arrived) < 40 and receipts == arrived
    again = delivery.Delivery(spark, str(tmp_path / "d"))
    again.prepare(rows.where("id < 0"), "item", ["id"], 10, encode=False)
    assert {r["batch_no"] for r in again.pending().collect()} == set(range(40)) - arrived
    results = again.run(arrive).collect()
    assert sorted((r["batch_no"], r["n_items"], r["ok"]) for r in results) == [(n, 10, True) for n in range(40)]
    assert sorted(int(p.name.split("-")[0]) for p in inbox.iterdir()) == [n * 10 for n in range(40)]
    assert again.run(arrive).count() == 40 and len(list(inbox.iterdir())) == 40


def test_batches_that_fail_stay_for_the_next_run(spark, tmp_path):
    rows = spark.range(10).select("id", F.col("id").cast("string").alias("item"))

    def refuse(payload):
        if "5" in payload:
            raise TimeoutError("slow")

    made = delivery.Delivery(spark, str(tmp_path / "d"))
    made.prepare(rows, "item", ["id"], 4, encode=False)
    got = {r["batch_no"]: (r["ok"], r["error"], r["payload"]) for r in made.run(refuse).collect()}
    assert got == {0: (True, None, None), 1: (False, "TimeoutError: slow", "[4,5,6,7]"), 2: (True, None, None)}
    assert [r["ok"] for r in made.run(json.loads).collect()] == [True] * 3
