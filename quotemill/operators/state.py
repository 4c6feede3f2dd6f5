"""What a closed history comes to: one row per ticker, merged by an associative rule.

The state of bars up to a day, merged with that of later bars, is the state of all. First close and
peak may also be merged with bars they have seen already; the number of rows may not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "ticker string, first_date date, first_close double, peak double, rows long, last_date date"


def history_state(bars: DataFrame) -> DataFrame:
    """State of (ticker, date, close); bars without a date are left out. NULL closes count as rows,
    and as the first close where they are it."""
    close = F.col("close").cast("double")
    dated = bars.filter(F.col("date").isNotNull())
    return dated.groupBy("ticker").agg(
        F.min("date").alias("first_date"),
        F.min_by(close, "date").alias("first_close"),
        F.max(close).alias("peak"),
        F.count(F.lit(1)).alias("rows"),
        F.max("date").alias("last_date"),
    )


def merged(*states: DataFrame) -> DataFrame:
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    return every.groupBy("ticker").agg(
        F.min("first_date").alias("first_date"),
        F.min_by("first_close", "first_date").alias("first_close"),
        F.max("peak").alias("peak"),
        F.sum("rows").alias("rows"),
        F.max("last_date").alias("last_date"),
    )


def as_bars(state: DataFrame) -> DataFrame:
    """Two bars a ticker that have the history's first close and its peak."""
    first = F.struct(F.col("first_date").alias("date"), F.col("first_close").alias("close"))
    highest = F.struct(F.col("last_date").alias("date"), F.col("peak").alias("close"))
    bars = F.when(F.col("rows") == 1, F.array(first)).otherwise(F.array(first, highest))
    return state.select("ticker", F.explode(bars).alias("b")).select("ticker", "b.date", "b.close")
