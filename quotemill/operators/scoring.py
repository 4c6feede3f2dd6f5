"""0–100 scores from indicators and statement ratios.

All thresholds and points below are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.tiers import above, below, exact, first_match
from quotemill.operators.timeline import Split, open_timeline

PRICE_ACTION_ROWS = 20


def trend_score() -> Column:
    close, sma_20, sma_50, sma_200 = map(F.col, ("close", "sma_20", "sma_50", "sma_200"))
    return first_match(
        [
            ((close > sma_20) & (close > sma_50) & (close > sma_200), 40),
            ((close > sma_20) & (close > sma_50), 30),
            (close > sma_20, 20),
            (close > sma_50, 10),
        ],
        otherwise=5,
    )


def momentum_score() -> Column:
    rsi = F.col("rsi_value")
    return first_match(
        [
            (rsi.between(50, 70), 30),
            (rsi.between(40, 80), 20),
            (rsi > 70, 15),
            (rsi.between(30, 40), 10),
            (rsi < 30, 5),
        ],
        otherwise=15,
    )


def macd_score() -> Column:
    macd, signal = F.col("macd_value"), F.col("macd_signal")
    return first_match(
        [
            ((macd > signal) & (macd > 0), 10),
            (macd > signal, 7),
            ((macd < signal) & (macd < 0), 3),
        ],
        otherwise=5,
    )


def price_action_score(change: str) -> Column:
    return above(change, {"10": 20, "5": 15, "0": 10, "-5": 5}, otherwise=0)


def technical_scores(indicators: DataFrame, split: Split | None = None) -> DataFrame:
    """Trend (40), momentum (30), MACD (10) and price action (20) points, and their sum."""
    line = open_timeline(indicators, lookback=PRICE_ACTION_ROWS, split=split)
    base = F.col("_base")
    scored = (
        line.rows.withColumn("_base", line.lag("close", PRICE_ACTION_ROWS))
        .withColumn("_change", F.try_divide(F.col("close") - base, base) * 100)
        .withColumn("trend_score", trend_score())
        .withColumn("momentum_score", momentum_score())
        .withColumn("macd_score", macd_score())
        .withColumn("price_action_score", price_action_score("_change"))
        .withColumn(
            "technical_score",
            F.col("trend_score")
            + F.col("momentum_score")
            + F.col("macd_score")
            + F.col("price_action_score"),
        )
    )
    return line.close(scored).select(
        "ticker",
        "date",
        "trend_score",
        "momentum_score",
        "macd_score",
        "price_action_score",
        "technical_score",
    )


MARGIN_TIERS = [  # gross, operating and net margin, points
    ("0.5", "0.25", "0.20", 15),
    ("0.4", "0.20", "0.15", 12),
    ("0.3", "0.15", "0.10", 9),
    ("0.2", "0.10", None, 6),
    ("0", None, "0", 3),
]
GROWTH_TIERS = {"0.20": 10, "0.15": 8, "0.10": 6, "0.05": 4, "0": 2}
EPS_GROWTH_TIERS = {"0.25": 10, "0.15": 8, "0.10": 6, "0.05": 4, "0": 2}


def profitability_score() -> Column:
    steps = []
    for gross, operating, net, points in MARGIN_TIERS:
        floors = {"gross_margin": gross, "operating_margin": operating, "net_margin": net}
        condition = F.lit(True)
        for margin, floor in floors.items():
            if floor is not None:
                condition = condition & (F.col(margin) > exact(floor))
        steps.append((condition, points))
    equity_return = above(
        "return_on_equity", {"0.20": 10, "0.15": 7, "0.10": 5, "0": 2}, otherwise=0
    )
    return first_match(steps, otherwise=0) + equity_return


def growth_score() -> Column:
    return (
        above("revenue_growth_yoy", GROWTH_TIERS, otherwise=0)
        + above("eps_growth_yoy", EPS_GROWTH_TIERS, otherwise=0)
        + above("fcf_growth_yoy", GROWTH_TIERS, otherwise=0)
    )


def financial_health_score() -> Column:
    return (
        above("current_ratio", {"2.0": 10, "1.5": 8, "1.0": 6, "0.75": 4}, otherwise=2)
        + below("debt_to_equity", {"0.3": 10, "0.5": 8, "1.0": 6, "2.0": 4}, otherwise=2)
        + above("fcf_margin", {"0.25": 5, "0.20": 4, "0.15": 3, "0.10": 2}, otherwise=1)
    )


def cash_quality_score() -> Column:
    return above(
        "fcf_to_net_income", {"1.2": 15, "1.0": 12, "0.8": 9, "0.5": 6}, otherwise=3
    ) + above("fcf_margin", {"0.20": 5, "0.15": 4, "0.10": 3}, otherwise=2)


def fundamental_scores(fundamentals: DataFrame) -> DataFrame:
    """Profitability (25), growth (30), financial health (25) and cash quality (20) points.

    A plain projection: no shuffle beyond what ``fundamentals`` needed.
    """
    scored = fundamentals.withColumns(
        {
            "profitability_score": profitability_score(),
            "growth_score": growth_score(),
            "financial_health_score": financial_health_score(),
            "cash_quality_score": cash_quality_score(),
        }
    ).withColumn(
        "fundamentals_score",
        F.col("profitability_score")
        + F.col("growth_score")
        + F.col("financial_health_score")
        + F.col("cash_quality_score"),
    )
    return scored.select(
        "ticker",
        "date",
        "fiscal_year",
        "profitability_score",
        "growth_score",
        "financial_health_score",
        "cash_quality_score",
        "fundamentals_score",
        "gross_margin",
        "operating_margin",
        "net_margin",
        "return_on_equity",
        "current_ratio",
        "debt_to_equity",
        "fcf_margin",
        "revenue_growth_yoy",
        "eps_growth_yoy",
        "fcf_growth_yoy",
    )
