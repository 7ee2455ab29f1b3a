"""Compare registered queries with their SQL: ``python tests/parity.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str, queries, oracles) -> str:
    df = queries[name](spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return f"rows only ({len(mine[1])})"
    cur = con.execute(oracles[name])
    theirs = canonical([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"COLUMNS {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"ROWS {len(mine[1])} / {len(theirs[1])}: {mine[1][:2]} / {theirs[1][:2]}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"VALUES {len(bad)} differ, e.g. {bad[0]}"
    kinds = {tuple(type(v).__name__ for v in r) for r in mine[1][:50]}
    other = {tuple(type(v).__name__ for v in r) for r in theirs[1][:50]}
    return f"ok ({len(mine[1])})" if kinds == other else f"TYPES {kinds} / {other}"


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as e:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        good = verdict.startswith(("ok", "rows only"))
        failed += not good
        print(f"{'PASS' if good else 'FAIL'} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    spark.stop()


if __name__ == "__main__":
    main()
