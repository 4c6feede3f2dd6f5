"""Ready-made questions over the exposed marts.

Ranked screens break ties by ticker and fiscal year, so their first rows are always the same.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotemill.operators.composite import WEIGHTS
from quotemill.operators.semantic import latest_rows, ordered, query

Marts = Mapping[str, DataFrame]


def strong_now(marts: Marts, top: int = 20, not_after: str | None = None) -> DataFrame:
    """Companies with the best composite score on the latest day."""
    rows = latest_rows(marts["industry_scores"], "technical_date", not_after)
    columns = ["ticker", "company_name", "sector", "technical_date", "fiscal_year", "composite_score_equal"]
    return ordered(rows.select(*columns), ["-composite_score_equal", "ticker", "fiscal_year"], top)


def ticker_performance(marts: Marts, ticker: str) -> DataFrame:
    """How one company has done, day by day."""
    rows = marts["price_performance"].filter(F.col("ticker") == ticker)
    columns = ["ticker", "date", "close", "daily_return", "cumulative_return", "rolling_1y_return", "drawdown_pct"]
    return rows.select(*columns)


def best_in_sector(marts: Marts, sector: str, top: int = 10, not_after: str | None = None) -> DataFrame:
    rows = latest_rows(marts["industry_scores"], "technical_date", not_after)
    rows = rows.filter(F.col("sector") == sector)
    columns = ["ticker", "company_name", "industry", "technical_date", "fiscal_year", "composite_score_equal"]
    return ordered(rows.select(*columns), ["-composite_score_equal", "ticker", "fiscal_year"], top)


def strong_fundamentals(marts: Marts, top: int = 20) -> DataFrame:
    columns = ["ticker", "date", "fiscal_year", "fundamentals_score", "profitability_score", "growth_score"]
    rows = marts["fundamental_scores"].select(*columns)
    return ordered(rows, ["-fundamentals_score", "ticker", "fiscal_year"], top)


def momentum_leaders(marts: Marts, top: int = 20, not_after: str | None = None) -> DataFrame:
    rows = latest_rows(marts["technical_scores"], "date", not_after)
    columns = ["ticker", "date", "momentum_score", "technical_score"]
    return ordered(rows.select(*columns), ["-momentum_score", "-technical_score", "ticker"], top)


def risk_adjusted(marts: Marts, top: int = 20) -> DataFrame:
    return query(
        marts,
        "price_performance",
        ["ticker", "sector"],
        ["avg_risk_adjusted_return", "avg_return_to_drawdown", "avg_volatility_30d", "observation_count"],
        order_by=["-avg_risk_adjusted_return"],
        limit=top,
    )


def sector_rotation(marts: Marts, grain: str = "month") -> DataFrame:
    """Average composite score per sector and period, and its change from the period before.

    The window runs over the aggregated periods, a few rows per sector.
    """
    periods = query(
        marts,
        "industry_scores",
        ["sector", "technical_date"],
        ["avg_composite_equal", "ticker_count"],
        time_grain=grain,
    )
    by_sector = Window.partitionBy("sector").orderBy("technical_date")
    change = F.col("avg_composite_equal") - F.lag("avg_composite_equal").over(by_sector)
    return periods.withColumn("change", change)


def rank_by_composite(
    marts: Marts,
    score: str = "composite_score_technical_bias",
    top: int = 20,
    not_after: str | None = None,
) -> DataFrame:
    if score not in WEIGHTS:
        raise ValueError(f"score must be one of {sorted(WEIGHTS)}")
    rows = latest_rows(marts["composite_scores"], "technical_date", not_after)
    columns = ["ticker", "technical_date", "fiscal_year", score]
    return ordered(rows.select(*columns), [f"-{score}", "ticker", "fiscal_year"], top)


def near_high(marts: Marts, within: float = 0.05, not_after: str | None = None) -> DataFrame:
    """Stocks no more than ``within`` below their peak on the latest day."""
    rows = latest_rows(marts["price_performance"], "date", not_after)
    close_to_peak = rows.filter(F.col("drawdown_pct") >= -within)
    columns = ["ticker", "company_name", "sector", "date", "close", "drawdown_pct"]
    return ordered(close_to_peak.select(*columns), ["-drawdown_pct", "ticker"])


def most_volatile(marts: Marts, top: int = 20) -> DataFrame:
    return query(
        marts,
        "price_performance",
        ["ticker"],
        ["avg_volatility_30d", "max_drawdown"],
        order_by=["-avg_volatility_30d"],
        limit=top,
    )


def _pattern(marts: Marts, condition, columns: list[str]) -> DataFrame:
    return marts["price_performance"].filter(condition).select("ticker", "date", *columns)


def momentum(marts: Marts, short: float = 0.1, medium: float = 0.1) -> DataFrame:
    """Days with high returns over both 30 and 90 rows."""
    condition = (F.col("rolling_30d_return") > short) & (F.col("rolling_90d_return") > medium)
    return _pattern(marts, condition, ["rolling_30d_return", "rolling_90d_return"])


def mean_reversion(marts: Marts, pullback: float = -0.1, trend: float = 0.1) -> DataFrame:
    """Days with a fall over 30 rows inside a rise over a year."""
    condition = (F.col("rolling_30d_return") < pullback) & (F.col("rolling_1y_return") > trend)
    return _pattern(marts, condition, ["rolling_30d_return", "rolling_1y_return"])


def regime_shift(marts: Marts) -> DataFrame:
    """Days whose 30-row and one-year returns point in opposite directions."""
    condition = F.signum("rolling_30d_return") * F.signum("rolling_1y_return") < 0
    return _pattern(marts, condition, ["rolling_30d_return", "rolling_1y_return"])


def risk_off(marts: Marts, volatility: float = 0.5, drawdown: float = -0.3) -> DataFrame:
    """Days with high volatility in a deep drawdown."""
    condition = (F.col("rolling_30d_volatility") > volatility) & (F.col("drawdown_pct") < drawdown)
    return _pattern(marts, condition, ["rolling_30d_volatility", "drawdown_pct"])
