"""Every registered query gives the rows of its SQL."""

import pytest
from parity import compare, connect

import __spark_entry__ as entry
from cohortloom import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, name, SF, plans.QUERIES, plans.ORACLES)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)
    assert set(plans.QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["distinct_id", "key", "value"]
    assert df.count() > 0
