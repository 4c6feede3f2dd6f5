"""Returns, volatility and drawdown per ticker and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.scalars import relative_change
from quotemill.operators.timeline import Split, open_timeline

# Rolling returns look back this many rows, not calendar days.
ROLLING_RETURNS = {"rolling_30d_return": 30, "rolling_90d_return": 90, "rolling_1y_return": 252}
VOLATILITY_ROWS = 30


def daily_price_changes(prices: DataFrame, split: Split | None = None) -> DataFrame:
    """Close, previous close and their difference."""
    line = open_timeline(prices.select("ticker", "date", "close"), lookback=1, split=split)
    changes = line.rows.withColumn("previous_day_close", line.lag("close")).withColumn(
        "price_change", F.col("close") - F.col("previous_day_close")
    )
    return line.close(changes)


def price_returns(
    prices: DataFrame, split: Split | None = None, earlier: DataFrame | None = None
) -> DataFrame:
    """Daily, cumulative and rolling returns, 30-row volatility and drawdown from the peak.

    Every window shares one partitioning and order, so a history is shuffled and sorted once.
    With ``earlier`` bars, ``prices`` need only hold the recent rows of each history: the older
    ones count towards the first close and the peak through one aggregate per ticker.
    """
    line = open_timeline(
        prices.select("ticker", "date", "close"),
        lookback=max(ROLLING_RETURNS.values()),
        first=["close"],
        running_max=["close"],
        split=split,
        earlier=earlier,
    )
    close = F.col("close")
    returns = (
        line.rows.withColumn("daily_return", relative_change(close, line.lag("close")))
        .withColumn("cumulative_return", relative_change(close, line.first("close")))
        .withColumns({n: relative_change(close, line.lag("close", k)) for n, k in ROLLING_RETURNS.items()})
        .withColumn("running_max_price", line.running_max("close"))
        .withColumn("rolling_30d_volatility", F.stddev_samp("daily_return").over(line.frame(VOLATILITY_ROWS)))
        .withColumn("drawdown_pct", relative_change(close, F.col("running_max_price")))
    )
    return line.close(returns).select(
        "ticker",
        "date",
        "close",
        "daily_return",
        "cumulative_return",
        *ROLLING_RETURNS,
        "rolling_30d_volatility",
        "running_max_price",
        "drawdown_pct",
    )
