"""What a table holds after an incremental write, and what an incremental build must read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.scalars import as_date, days_before

BROADCAST_KEYS = 1_000_000  # keys with too few recent rows that every task may hold; beyond, joins are shuffled


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose keys are in ``batch``, and all rows of ``batch``.

    Rows with a NULL key match nothing and stay.
    """
    return target.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)


def in_range(column: str, start: str | dt.date, end: str | dt.date) -> Column:
    """Both bounds included; a NULL date is outside."""
    inside = F.col(column).between(as_date(start), as_date(end))
    return F.coalesce(inside, F.lit(False))


def replace_range(
    existing: DataFrame,
    batch: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    column: str = "date",
) -> DataFrame:
    """``existing`` without its rows from ``start`` to ``end``, and all rows of ``batch``.

    Days of the range that ``batch`` does not cover end up empty.
    """
    return existing.filter(~in_range(column, start, end)).unionByName(batch)


def replace_day(
    existing: DataFrame, batch: DataFrame, day: str | dt.date, column: str = "date"
) -> DataFrame:
    return replace_range(existing, batch, day, day, column)


def date_bounds(batch: DataFrame, column: str = "date") -> tuple[dt.date | None, dt.date | None]:
    """First and last date of a batch."""
    bounds = batch.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return bounds["low"], bounds["high"]


def recent_rows(
    df: DataFrame,
    since: dt.date,
    rows: int,
    days: int,
    key: str = "ticker",
    date: str = "date",
    first_dates: DataFrame | None = None,
    whole: bool = True,
) -> DataFrame:
    """Rows from ``since`` on, with at least the ``rows`` rows before it of every key seen there.

    ``days`` calendar days usually hold that many rows, and only those partitions are read. Keys
    that have fewer rows in them (holidays, thin trading) get their older rows as well, all of them
    or, unless ``whole``, those from the month on in which their last ``rows`` rows before ``since``
    begin, as row counts by month tell. Whether there are any is found out first, from the recent
    partitions; if not, the older partitions are not in the plan. ``first_dates`` has (key, first_date) of all keys with rows before the recent
    partitions, so that keys with nothing older, such as new listings, ask for nothing.
    """
    near_start = as_date(days_before(since, days))
    near = df.filter(F.col(date) >= near_start)
    new = F.col(date) >= as_date(since)
    short = (
        near.groupBy(key)
        .agg(F.max(new).alias("_active"), F.count_if(~new).alias("_before"))
        .filter(F.col("_active") & (F.col("_before") < rows))
        .select(key, "_before")
    )
    if first_dates is not None:
        listed = first_dates.filter(F.col("first_date") < near_start)
        short = short.join(listed.select(key), key, "left_semi")
    found = short.limit(BROADCAST_KEYS + 1).count()
    if not found:
        return near
    held = F.broadcast if found <= BROADCAST_KEYS else lambda keys: keys
    older = df.filter(F.col(date) < near_start)
    if whole:
        return near.unionByName(older.join(held(short.select(key)), key, "left_semi"))
    months = older.groupBy(key, F.trunc(date, "month").alias("_month")).agg(F.count(F.lit(1)).alias("_rows"))
    newer = Window.partitionBy(key).orderBy(F.desc("_month")).rowsBetween(Window.unboundedPreceding, -1)
    counted = months.join(held(short), key).withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
    needed = counted.filter(F.col("_before") + F.col("_newer") < rows)
    begin = needed.groupBy(key).agg(F.min("_month").alias("_begin"))
    older = older.join(held(begin), key).filter(F.col(date) >= F.col("_begin")).select(*df.columns)
    return near.unionByName(older)
