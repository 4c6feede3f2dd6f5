"""Technical and fundamental scores brought together, and the marts built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.tiers import exact
from quotemill.operators.companies import named, with_company

# Weight of the technical and of the fundamental score.
WEIGHTS = {
    "composite_score_equal": ("0.5", "0.5"),
    "composite_score_technical_bias": ("0.6", "0.4"),
    "composite_score_fundamental_bias": ("0.4", "0.6"),
}

#: Companies whose names the driver holds beside the plan behind the composite scores.
SCORED_COMPANIES = 100_000

MATCHING = ("inclusive", "half_open", "asof")


def fiscal_periods(scores: DataFrame) -> DataFrame:
    """Each fiscal year with its end date and the end date of the year before as its start."""
    by_year = Window.partitionBy("ticker").orderBy(F.col("fiscal_year").asc_nulls_last())
    return scores.select(
        "ticker",
        "fiscal_year",
        F.lag("date").over(by_year).alias("fiscal_year_start_date"),
        F.col("date").alias("fiscal_year_end_date"),
        "fundamentals_score",
        "profitability_score",
        "growth_score",
        "financial_health_score",
        "cash_quality_score",
    )


def composite_scores(technical: DataFrame, fundamental: DataFrame, matching: str = "inclusive") -> DataFrame:
    """Daily technical scores with the fundamental scores of a fiscal year, three ways weighted.

    ``matching`` says which fiscal year a day gets:

    * ``"inclusive"``: the year whose start and end enclose the day. Both bounds count, so a day
      that ends a fiscal year also starts the next one and appears twice.
    * ``"half_open"``: the same without the start day, so a day appears once.
    * ``"asof"``: the last year that ended on or before the day.

    The join is on the ticker with the dates as a further condition; both sides come out of
    windows on the ticker, so it needs no shuffle of its own.
    """
    if matching not in MATCHING:
        raise ValueError(f"matching must be one of {MATCHING}, not {matching!r}")
    periods = fiscal_periods(fundamental)
    if matching == "asof":
        by_end = Window.partitionBy("ticker").orderBy("fiscal_year_end_date", "fiscal_year")
        periods = periods.withColumn("_next_end", F.lead("fiscal_year_end_date").over(by_end))
    days = technical.withColumnRenamed("date", "technical_date").alias("t")
    years = periods.alias("f")
    day = F.col("t.technical_date")
    start, end = F.col("f.fiscal_year_start_date"), F.col("f.fiscal_year_end_date")
    within = {
        "inclusive": lambda: day.between(start, end),
        "half_open": lambda: (day > start) & (day <= end),
        "asof": lambda: (day >= end) & (F.col("f._next_end").isNull() | (day < F.col("f._next_end"))),
    }[matching]()
    joined = days.join(years, (F.col("t.ticker") == F.col("f.ticker")) & within, "left")
    technical_score, fundamentals_score = F.col("t.technical_score"), F.col("f.fundamentals_score")
    return joined.select(
        "t.ticker",
        "t.technical_date",
        "t.technical_score",
        "f.fiscal_year",
        "f.fiscal_year_start_date",
        "f.fiscal_year_end_date",
        "f.fundamentals_score",
        "t.trend_score",
        "t.momentum_score",
        "t.macd_score",
        "t.price_action_score",
        "f.profitability_score",
        "f.growth_score",
        "f.financial_health_score",
        "f.cash_quality_score",
        *[
            (technical_score * exact(technical_weight) + fundamentals_score * exact(fundamental_weight)).alias(name)
            for name, (technical_weight, fundamental_weight) in WEIGHTS.items()
        ],
    )


def industry_scores(composite: DataFrame, companies: DataFrame, recent: bool = False) -> DataFrame:
    """Composite scores with company, sector and industry.

    ``recent`` rows are those of a few days: they are joined as the planner likes, so the driver need
    not hold all names for them.
    """
    return with_company(composite, companies if recent else named(companies, SCORED_COMPANIES)).select(
        "ticker",
        "company_name",
        "sector",
        "industry",
        *WEIGHTS,
        "technical_score",
        "fundamentals_score",
        "technical_date",
        "fiscal_year",
        "fiscal_year_start_date",
        "fiscal_year_end_date",
    )


def price_performance(returns: DataFrame, companies: DataFrame, recent: bool = False) -> DataFrame:
    """Returns, volatility and drawdown with company, sector and industry; ``recent`` as in
    ``industry_scores``."""
    enriched = with_company(returns, companies if recent else named(companies))
    return enriched.select(*returns.columns, "company_name", "sector", "industry")
