"""Small column expressions shared by feeds and operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def as_date(value: str | dt.date | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def days_before(value: str | dt.date, days: int) -> dt.date:
    day = value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
    return day - dt.timedelta(days=days)


def epoch_millis(c: Column) -> Column:
    """Epoch milliseconds → zone-free UTC timestamp; 0 and NULL count as missing."""
    seconds = (c / F.lit(1000)).cast("decimal(18,6)")
    stamp = F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )
    return F.when(c != 0, stamp)


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text → zone-free timestamp; an offset is dropped, not applied."""
    return c.try_cast("timestamp_ntz")


def statement_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text → timestamp, NULL when it does not parse."""
    shape = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
    return F.when(c.rlike(shape), c.try_cast("timestamp_ntz"))


def before_end_of_day(stamp: Column, day: str | dt.date) -> Column:
    return stamp < F.date_add(as_date(day), 1).cast("timestamp_ntz")


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else NULL."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def relative_change(current: Column, base: Column) -> Column:
    """``current / base - 1``; a zero base gives NULL."""
    return F.try_divide(current, base) - F.lit(1)


def mentioned_tickers(text: Column) -> Column:
    """``"NYSE:MRK, NASDAQ:AAPL"`` → ``[MRK, AAPL]``; blank entries are skipped."""
    parts = F.filter(F.split(text, ","), lambda p: F.length(strip(p)) > 0)
    return F.transform(parts, lambda p: strip(F.element_at(F.split(p, ":"), -1)))


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def json_text(c: Column) -> Column:
    """JSON text of a list; a missing list is JSON ``null``, not SQL NULL."""
    return F.coalesce(F.to_json(c), F.lit("null"))
