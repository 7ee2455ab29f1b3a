import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import properties as P
from cohortloom.functions import times as T


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("hours, expected", [(-8, 128800), (0, 100000), (5.5, 80200)])
def test_to_utc(spark, hours, expected):
    assert one(spark, T.to_utc(F.lit(100000), hours)) == expected
    assert one(spark, T.to_utc(T.to_utc(F.lit(100000), hours), -hours)) == 100000


def test_epochs_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.lit("2024-01-01 00:00:00.0019").cast("timestamp_ntz")
        assert one(spark, T.epoch_ms(ts)) == 1704067200001
        assert one(spark, T.epoch_s(T.from_epoch_s(F.lit(1704067200)))) == 1704067200
        # New York's clocks skip this half past two.
        skipped = F.lit("2024-03-10 02:30:00.0019").cast("timestamp_ntz")
        assert one(spark, T.epoch_ms(skipped)) == 1710037800001
        assert one(spark, P.json_text(skipped, "timestamp_ntz")) == '"2024-03-10T02:30:00"'
        hour = T.parse_hour_stamp(F.lit("20240310T02"))
        assert one(spark, T.epoch_s(hour)) == 1710036000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "Etc/UTC")


def test_export_times(spark):
    for text, ms in (("2024-01-01 00:00:00", 0), ("2024-01-01 00:00:00.25", 250)):
        assert one(spark, T.epoch_ms(T.parse_export_time(F.lit(text)))) == 1704067200000 + ms
    with pytest.raises(Exception):
        one(spark, T.parse_export_time(F.lit("not a time")))
    assert one(spark, T.parse_hour_stamp(F.lit("2024-03-10"))) is None
    assert one(spark, T.parse_iso(F.lit("not a time"))) is None


@pytest.mark.parametrize(
    "start, end, n, expected",
    [
        ("2024-02-28", "2024-03-01", 1, [("28", "28"), ("29", "29"), ("01", "01")]),
        ("2024-02-28", "2024-03-01", 2, [("28", "29"), ("01", "01")]),
        ("2024-02-28", "2024-03-01", 0, [("28", "28"), ("29", "29"), ("01", "01")]),
        ("2024-02-28", "2024-03-01", 30, [("28", "01")]),
        ("2024-03-02", "2024-03-01", 1, []),
    ],
)
def test_date_chunks(spark, start, end, n, expected):
    df = spark.createDataFrame(
        [(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "a date, b date"
    )
    rows = T.with_date_chunks(df, "a", "b", n).orderBy("chunk_start").collect()
    got = [(r["chunk_start"].strftime("%d"), r["chunk_end"].strftime("%d")) for r in rows]
    assert got == expected


def test_day_range_is_inclusive(spark):
    rows = [(T.epoch_of("2024-01-05") + s,) for s in (-1, 0, 86399, 86400)]
    df = spark.createDataFrame(rows, "time bigint")
    assert df.where(T.in_days("time", "2024-01-05", dt.datetime(2024, 1, 5, 9))).count() == 2
