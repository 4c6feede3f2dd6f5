"""Incremental model builds: what each reads, and from which day on it writes.

Fixed values: the write span, and the rows and calendar days each model looks back. The rows
decide; the days are the partitions read first, and tickers with fewer rows in them get more.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.scalars import as_date, days_before
from quotemill.operators.indicators import technical_indicators
from quotemill.operators.merge import recent_rows
from quotemill.operators.returns import daily_price_changes, price_returns
from quotemill.operators.scoring import technical_scores
from quotemill.operators.state import as_bars
from quotemill.operators.timeline import Split

WRITE_DAYS = 3


@dataclass(frozen=True)
class Lookback:
    rows: int
    days: int


LOOKBACKS = {
    "daily_price_changes": Lookback(rows=1, days=4),
    "technical_indicators": Lookback(rows=200, days=300),
    "price_returns": Lookback(rows=252, days=400),
    "technical_scores": Lookback(rows=20, days=40),
}

# Days re-read by the models that only join: they look at no earlier row.
JOIN_DAYS = {"composite_scores": 3, "industry_scores": 3, "price_performance": 7}


def write_start(last_date: dt.date) -> dt.date:
    """First day an incremental run rewrites, given the last day its table holds."""
    return days_before(last_date, WRITE_DAYS)


def _since(df: DataFrame, since: dt.date) -> DataFrame:
    return df.filter(F.col("date") >= as_date(since))


def near_start(since: dt.date, model: str) -> dt.date:
    """First day of the partitions that an incremental run of a model reads."""
    return days_before(since, LOOKBACKS[model].days)


def _recent(df: DataFrame, since: dt.date, model: str, closed: DataFrame | None = None) -> DataFrame:
    span = LOOKBACKS[model]
    return recent_rows(df, since, span.rows, span.days, first_dates=closed, whole=False)


def new_price_changes(
    prices: DataFrame, since: dt.date, split: Split | None = None, closed: DataFrame | None = None
) -> DataFrame:
    return _since(daily_price_changes(_recent(prices, since, "daily_price_changes", closed), split), since)


def new_price_returns(
    prices: DataFrame, since: dt.date, split: Split | None = None, closed: DataFrame | None = None
) -> DataFrame:
    """Cumulative return and drawdown need the whole history, the rest a year of rows.

    ``closed`` is the state of the bars before ``near_start``: with it no older bar is read, unless
    a ticker has too few rows since. Without, the older bars are read for their first close and
    peak, which is one aggregate per ticker formed before the shuffle.
    """
    recent = _recent(prices, since, "price_returns", closed)
    if closed is not None:
        earlier = as_bars(closed)
    else:
        start = as_date(near_start(since, "price_returns"))
        earlier = prices.filter(F.col("date") < start).select("ticker", "date", "close")
    return _since(price_returns(recent, split, earlier), since)


def new_technical_indicators(
    prices: DataFrame,
    rsi: DataFrame,
    macd: DataFrame,
    since: dt.date,
    split: Split | None = None,
    closed: DataFrame | None = None,
) -> DataFrame:
    recent = _recent(prices, since, "technical_indicators", closed)
    return _since(technical_indicators(recent, _since(rsi, since), _since(macd, since), split), since)


def new_technical_scores(
    indicators: DataFrame, since: dt.date, split: Split | None = None, closed: DataFrame | None = None
) -> DataFrame:
    return _since(technical_scores(_recent(indicators, since, "technical_scores", closed), split), since)
