"""Time expressions: project-zone shifts, epochs, tolerant parsing, day chunks.

Epochs are computed from ``TIMESTAMP_NTZ`` so no result depends on the session
or machine time zone; a naive time is read as UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

_EPOCH = "1970-01-01 00:00:00"

Day = dt.date | dt.datetime | str


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_day(day: Day) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def epoch_of(day: Day) -> int:
    """Epoch seconds of a day's first instant."""
    return (as_day(day) - dt.date(1970, 1, 1)).days * 86400


def ntz(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def _since_epoch(ts: Column | str) -> Column:
    # An interval of two zone-less times. timestampdiff() would go through the
    # session zone and be an hour off where its clocks skip one.
    gap = ntz(ts) - ntz(F.lit(_EPOCH))
    return gap.cast("interval second").cast("decimal(18,6)")


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since the epoch, truncated."""
    return (_since_epoch(ts) * 1000).cast("bigint")


def epoch_s(ts: Column | str) -> Column:
    """Seconds since the epoch, truncated."""
    return _since_epoch(ts).cast("bigint")


def from_epoch_s(seconds: Column | str) -> Column:
    """Epoch seconds to ``TIMESTAMP_NTZ`` (UTC)."""
    return F.timestamp_add("SECOND", _col(seconds).cast("bigint"), ntz(F.lit(_EPOCH)))


def to_utc(seconds: Column | str, offset_hours: float) -> Column:
    """Project-zone epoch seconds to UTC, truncated toward zero.

    ``offset_hours`` may have a fraction (half-hour zones).
    """
    whole = _col(seconds).try_cast("bigint")
    shift = offset_hours * 3600
    if float(shift).is_integer():
        return whole - F.lit(int(shift)).cast("bigint")
    return (whole - F.lit(float(shift))).cast("bigint")


def query_time(ms: Column | str, offset_hours: float = 0) -> Column:
    """Epoch milliseconds to fractional seconds in UTC, as the query projection gives it."""
    return _col(ms) / F.lit(1000.0) - F.lit(float(offset_hours * 3600))


def parse_iso(text: Column | str, strict: bool = False) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` (optional fraction) to ``TIMESTAMP_NTZ``.

    Malformed text is NULL, or an error when ``strict``.
    """
    text = _col(text)
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def parse_export_time(text: Column | str, strict: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with or without a fraction; anything else is an error."""
    return parse_iso(text, strict)


def parse_hour_stamp(text: Column | str) -> Column:
    """``yyyyMMddTHH`` hour stamps of archive ranges; malformed text is NULL."""
    text = _col(text)
    stamp = r"^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})$"
    iso = F.regexp_replace(text, stamp, "$1-$2-$3 $4:00:00")
    return F.when(text.rlike(stamp), iso.try_cast("timestamp_ntz"))


def day_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def in_days(c: Column | str, from_date: Day, to_date: Day, unit: str = "s") -> Column:
    """Inclusive day range on a time column, as a half-open comparison with literals.

    ``unit`` is ``s`` or ``ms`` for epoch columns, ``ts`` for timestamps. The
    column stays bare so that Parquet can use the comparison.
    """
    c = _col(c)
    start, stop = as_day(from_date), as_day(to_date) + dt.timedelta(days=1)
    if unit == "ts":
        low, high = (
            F.lit(dt.datetime.combine(d, dt.time()).isoformat(sep=" ")).cast("timestamp_ntz")
            for d in (start, stop)
        )
    elif unit in ("s", "ms"):
        scale = 1000 if unit == "ms" else 1
        low, high = F.lit(epoch_of(start) * scale), F.lit(epoch_of(stop) * scale)
    else:
        raise ValueError(f"unit must be s, ms or ts: {unit}")
    return (c >= low) & (c < high)


def with_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included."""
    days = F.sequence(F.col(start), F.col(end), F.make_dt_interval(F.lit(1)))
    return df.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(days))


def with_date_chunks(
    df: DataFrame,
    start: str,
    end: str,
    increment: Column | int,
    out_start: str = "chunk_start",
    out_end: str = "chunk_end",
) -> DataFrame:
    """Split each row's inclusive date range into chunks of ``increment`` days.

    The last chunk ends at the range's end; an increment below 1 counts as 1.
    """
    n = F.greatest(
        (increment if isinstance(increment, Column) else F.lit(increment)).cast("int"), F.lit(1)
    )
    starts = F.sequence(F.col(start), F.col(end), F.make_dt_interval(n))
    return (
        df.where(F.col(start) <= F.col(end))
        .withColumn(out_start, F.explode(starts))
        .withColumn(out_end, F.least(F.date_add(F.col(out_start), n - 1), F.col(end)))
    )
