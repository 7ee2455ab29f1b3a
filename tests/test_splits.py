"""Files cut into blocks give the rows of plain parsing, wherever the cuts fall."""

import csv
import gzip
import io
import json

import numpy as np
import pytest

from cohortloom.sources import csv_files, json_files, splits


def items_text(rng, n):
    parts = ["plain", 'quo"te', "back\\slash", "[br]ack{ets}", "com,ma", "\\\\\\", 'end\\"', "new\nline", "é中", ""]
    def value(depth):
        kind = rng.integers(0, 5 if depth else 3)
        if kind == 0:
            return int(rng.integers(0, 100))
        if kind < 3:
            return "".join(rng.choice(parts, rng.integers(0, 4)))
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.integers(0, 3))]
        return {f"k{i}": value(depth - 1) for i in range(rng.integers(0, 3))}
    return [{"n": i, "v": value(3)} for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("separators", [(",", ":"), (" , ", " : ")])
def test_json_items_of_any_blocks(spark, tmp_path, block, separators):
    items = items_text(np.random.default_rng(block), 12 if block == 1 else 60)
    text = "﻿ \n" + json.dumps(items, separators=separators, ensure_ascii=False) + "\n"
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(json.dumps(items[:7], indent=1).encode()))
    (tmp_path / "c.json").write_text('{"n": -1,\n "v": "[,]"}')
    (tmp_path / "d.json").write_text("[ ]")
    rows = splits.json_items(spark, str(tmp_path), block).collect()
    assert all(r["whole"] for r in rows)
    found = sorted((json.loads(r["record"]) for r in rows), key=lambda x: (x["n"], str(x)))
    assert found == sorted([*items, *items[:7], {"n": -1, "v": "[,]"}], key=lambda x: (x["n"], str(x)))


def test_one_line_is_read_by_many_tasks(spark, tmp_path):
    event = {"event": "e", "properties": {"distinct_id": 'a"]', "time": 1}}
    (tmp_path / "a.json").write_text(json.dumps([event] * 20_000))
    found = splits.json_items(spark, str(tmp_path), 100_000)
    found.createOrReplaceTempView("found")
    counts = spark.sql("SELECT spark_partition_id() AS task, count(*) AS n FROM found GROUP BY 1").collect()
    assert sum(r["n"] for r in counts) == 20_000 and len(counts) > 4 and max(r["n"] for r in counts) < 10_000


def test_an_array_without_an_end(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"event":"e","properties":{}},{"event":"f"')
    with pytest.raises(Exception, match="without an end"):
        json_files.read_events(spark, str(path), whole_file=True).collect()
    rows = json_files.read_events(spark, str(path), whole_file=True, fail_fast=False).collect()
    assert sorted((r["event"] or "", r["_corrupt_record"] or "") for r in rows) == [("", '{"event":"f"'), ("e", "")]
    path.write_text('[{"event":"e","properties":{}}, 5, {"event" "f"}]')
    rows = json_files.read_events(spark, str(path), whole_file=True, fail_fast=False).collect()
    assert sum(r["_corrupt_record"] is not None for r in rows) == 2
    with pytest.raises(Exception):
        json_files.read_events(spark, str(path), whole_file=True).collect()


def plain_rows(text):
    table = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return [{k: v for k, v in zip(table[0], r) if v} for r in table[1:]] if table else []


@pytest.mark.parametrize("block", [1, 3, 11, 200, 1 << 20])
def test_csv_rows_of_any_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    cells = ["a", "", "two\nlines", 'q"q', '"', '""', "x,y", "\n", 'end"', ' "lead', "é", "\n\n,\n", "1.5"]
    for k, end in enumerate(("\n", "\r\n")):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", f"na\nme{k}", "c", "d"])
        for i in range(20 if block < 5 else 80):
            writer.writerow([i, *rng.choice(cells, rng.integers(0, 4))])
        text = out.getvalue() + '9,5" pipe,in "cell" quotes,x""\n' + '10,"quoted"tail,"",z'
        (tmp_path / f"{k}.csv").write_bytes(b"\xef\xbb\xbf" * k + text.encode())
    (tmp_path / "g.csv.gz").write_bytes(gzip.compress('id,c\n1,"x\ny"\n'.encode()))
    (tmp_path / "h.csv").write_text("id,only header\n")
    found = splits.csv_rows(spark, str(tmp_path), block).collect()
    for name in ("0.csv", "1.csv", "g.csv.gz", "h.csv"):
        data = (tmp_path / name).read_bytes()
        text = (gzip.decompress(data) if name.endswith("gz") else data).decode("utf-8-sig")
        key = lambda r: sorted(r.items())
        mine = [r["cells"] for r in found if r["path"].endswith(name)]
        assert sorted(mine, key=key) == sorted(plain_rows(text), key=key), name


def test_files_with_other_headers_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event,distinct_id,time,k\ne,a,5,1\n")
    (tmp_path / "b.csv").write_text('time,note,event,distinct_id\n6,"two\nlines",f,b\n')
    rows = {r["event"]: (r["distinct_id"], r["time"], r["properties"]) for r in csv_files.read_events(spark, str(tmp_path)).collect()}
    assert rows == {"e": ("a", 5, {"k": "1"}), "f": ("b", 6, {"note": '"two\\nlines"'})}
    (tmp_path / "c.csv").write_text("event,time\ne,1\n")
    with pytest.raises(ValueError, match="distinct_id.*c.csv"):
        csv_files.read_events(spark, str(tmp_path))
