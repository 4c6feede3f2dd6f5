"""The models of the latest day alone, from the bars that its rows depend on.

A row looks back a number of rows, not days. How far that reaches is told by an index of row counts
per ticker and month: one aggregate, or a small stored table. It gives the first day to read, a
plain date, so that the filter reaches the scans. First closes and peaks come from the state of the
bars before that day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.scalars import as_date
from quotemill.operators import returns
from quotemill.operators.indicators import SMA_WINDOWS
from quotemill.operators.returns import ROLLING_RETURNS
from quotemill.operators.state import as_bars, history_state
from quotemill.plans.marts import Marts

DAILY = ("stock_prices", "rsi", "macd")
#: Rows that a day's scores, and its returns, depend on.
SCORE_ROWS = max(SMA_WINDOWS.values())
RETURN_ROWS = max(ROLLING_RETURNS.values()) + 1


def listing(bars: DataFrame) -> DataFrame:
    """(ticker, month, rows, last_date): row counts of each history by month."""
    dated = bars.filter(F.col("date").isNotNull())
    return dated.groupBy("ticker", F.trunc("date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_date")
    )


def first_day(index: DataFrame, rows: int) -> dt.date | None:
    """First day of the month in which the last ``rows`` rows begin, of all tickers that have a row on
    the latest day; None for an empty index. The windows see a row per ticker and month."""
    newer = Window.partitionBy("ticker").orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
    needed = index.withColumn("_newer", F.coalesce(F.sum("rows").over(newer), F.lit(0))).filter(F.col("_newer") < rows)
    begin = needed.groupBy("ticker").agg(F.min("month").alias("begin"), F.max("last_date").alias("last_date"))
    return begin.groupBy("last_date").agg(F.min("begin").alias("begin")).agg(F.max_by("begin", "last_date")).first()[0]


@dataclass(frozen=True)
class LatestMarts(Marts):
    """The models over the bars from ``start`` on, right for the last day; ``older`` is the state of
    those before."""

    start: dt.date | None = None
    older: DataFrame | None = None

    def _stage(self, name: str) -> DataFrame:
        rows = super()._stage(name)
        return rows.filter(F.col("date") >= as_date(self.start)) if name in DAILY else rows

    @cached_property
    def price_returns(self) -> DataFrame:
        return returns.price_returns(self._stage("stock_prices"), earlier=as_bars(self.older))


def latest(
    raw: Mapping[str, DataFrame],
    rows: int = SCORE_ROWS,
    not_after: str | None = None,
    index: DataFrame | None = None,
    closed: DataFrame | None = None,
    include_backfill: bool = False,
) -> Marts:
    """Models for the latest day (not after a given one): ``rows`` is how many rows it depends on.

    ``index`` and ``closed`` are stored tables of ``listing`` and of the histories' state; without
    them both are formed from the bars.
    """
    whole = Marts(raw, include_backfill)
    bars = whole._stage("stock_prices").select("ticker", "date", "close")
    if not_after is not None:
        index = listing(bars.filter(F.col("date") <= as_date(not_after)))
    start = first_day(listing(bars) if index is None else index, rows)
    if start is None:
        return whole
    older = history_state(bars.filter(F.col("date") < as_date(start))) if closed is None else closed
    return LatestMarts(raw, include_backfill, start, older)
