"""Registered queries against their SQL, on the smallest tables and on tables of several files."""

import pytest
from parity import TABLES, compare, connect

from cohortloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    verdict = compare(spark, con, name, SF, queries.QUERIES, queries.ORACLES)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_on_tables_of_several_files(spark, con, name, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    for t in ("documents", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(3).write.parquet(f"{folder}/{t}.parquet")
    verdict = compare(spark, con, name, str(folder), queries.QUERIES, queries.ORACLES)
    assert verdict.startswith("ok"), verdict


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(TABLES) == 14
