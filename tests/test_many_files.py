"""Every registered query over tables that are folders of several files."""

import pytest
from parity import TABLES, compare, connect

from cohortloom import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = tmp_path_factory.mktemp("tables")
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(3).write.parquet(f"{made}/{t}.parquet")
    return str(made)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, con, folder, name):
    verdict = compare(spark, con, name, folder, plans.QUERIES, plans.ORACLES)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_query_is_empty(sf):
    con = connect(f"/root/testdata/{sf}")
    empty = [n for n, sql in plans.ORACLES.items() if not con.execute(sql).fetchone()]
    assert empty == []
