"""Annual statements joined to one row per ticker and year, with ratios and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.scalars import guarded_ratio

# The statement columns carried on, ratio definitions and growth columns.
INCOME_COLUMNS = """
    date ticker fiscal_year period revenue cost_of_revenue gross_profit operating_income
    net_income eps_diluted ebitda weighted_average_shares_out_diluted
""".split()
BALANCE_COLUMNS = """
    total_assets total_current_assets cash_and_short_term_investments net_receivables
    total_liabilities total_current_liabilities total_stockholders_equity total_debt net_debt
""".split()
CASH_FLOW_COLUMNS = "operating_cash_flow free_cash_flow capital_expenditure".split()

RATIOS = {  # name: (numerator, denominator)
    "gross_margin": ("gross_profit", "revenue"),
    "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"),
    "return_on_equity": ("net_income", "total_stockholders_equity"),
    "return_on_assets": ("net_income", "total_assets"),
    "current_ratio": ("total_current_assets", "total_current_liabilities"),
    "quick_ratio": ("cash_and_short_term_investments + net_receivables", "total_current_liabilities"),
    "debt_to_equity": ("total_debt", "total_stockholders_equity"),
    "debt_to_assets": ("total_debt", "total_assets"),
    "fcf_margin": ("free_cash_flow", "revenue"),
    "fcf_to_net_income": ("free_cash_flow", "net_income"),
    "revenue_per_share": ("revenue", "weighted_average_shares_out_diluted"),
    "fcf_per_share": ("free_cash_flow", "weighted_average_shares_out_diluted"),
    "book_value_per_share": ("total_stockholders_equity", "weighted_average_shares_out_diluted"),
}

GROWTH = {  # name: amount compared with the year before
    "revenue_growth_yoy": "revenue",
    "net_income_growth_yoy": "net_income",
    "eps_growth_yoy": "eps_diluted",
    "fcf_growth_yoy": "free_cash_flow",
    "operating_cash_flow_growth_yoy": "operating_cash_flow",
}

STATEMENT_KEYS = ["ticker", "date", "fiscal_year"]


def join_statements(income: DataFrame, balance: DataFrame, cash_flow: DataFrame) -> DataFrame:
    """Full-year income statements with the balance sheet and cash flow of the same day and year.

    The period is checked on the income side only, so a balance sheet or cash flow row of another
    period with the same keys multiplies the result. The three sides share their join keys and
    are shuffled once each.
    """
    yearly = income.filter(F.col("period") == "FY").select(*INCOME_COLUMNS)
    return yearly.join(balance.select(*STATEMENT_KEYS, *BALANCE_COLUMNS), STATEMENT_KEYS).join(
        cash_flow.select(*STATEMENT_KEYS, *CASH_FLOW_COLUMNS), STATEMENT_KEYS
    )


def add_ratios(statements: DataFrame) -> DataFrame:
    """Margins, returns, liquidity, leverage, cash and per-share ratios."""
    return statements.withColumns(
        {name: guarded_ratio(F.expr(top), F.col(bottom)) for name, (top, bottom) in RATIOS.items()}
    )


def add_growth(statements: DataFrame) -> DataFrame:
    """Change against the ticker's previous statement, where that was positive.

    A ticker has one full-year statement per year, so its window is a few dozen rows.
    """
    by_date = Window.partitionBy("ticker").orderBy(F.col("date").asc_nulls_last())
    before = {name: F.lag(amount).over(by_date) for name, amount in GROWTH.items()}
    growth = {
        name: guarded_ratio(F.col(amount) - F.col(f"_{name}"), F.col(f"_{name}"))
        for name, amount in GROWTH.items()
    }
    return (
        statements.withColumns({f"_{name}": value for name, value in before.items()})
        .withColumns(growth)
        .drop(*[f"_{name}" for name in GROWTH])
    )


def fundamentals(income: DataFrame, balance: DataFrame, cash_flow: DataFrame) -> DataFrame:
    return add_growth(add_ratios(join_statements(income, balance, cash_flow)))
