import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from cohortloom.session import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def profiles_of(spark):
    """Profiles from ``{id: {name: Python value}}``."""
    from cohortloom.functions.properties import literal_text

    def make(people: dict):
        rows = [(i, {k: literal_text(v) for k, v in m.items()}) for i, m in people.items()]
        return spark.createDataFrame(rows, "distinct_id string, properties map<string,string>")

    return make


@pytest.fixture(scope="session")
def as_dict():
    """Profiles back to ``{id: {name: Python value}}``."""
    import json

    def read(df):
        return {
            r["distinct_id"]: {k: json.loads(v) for k, v in r["properties"].items()}
            for r in df.collect()
        }

    return read
