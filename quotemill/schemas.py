"""Table and feed schemas.

The column names and types below are fixed values: the tables must look the way existing
consumers of the data expect them.
"""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(38, 0)  # whole currency units or shares


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


def flat(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# ---------------------------------------------------------------------------
# Statement amounts
# ---------------------------------------------------------------------------

STATEMENT_HEAD = flat(
    "ticker string, date date, reported_currency string, cik string, filing_date date, "
    "accepted_date timestamp_ntz, fiscal_year string, period string"
)

INCOME_AMOUNTS = """
    revenue cost_of_revenue gross_profit research_and_development_expenses
    general_and_administrative_expenses selling_and_marketing_expenses
    selling_general_and_administrative_expenses other_expenses operating_expenses
    cost_and_expenses net_interest_income interest_income interest_expense
    depreciation_and_amortization ebitda ebit non_operating_income_excluding_interest
    operating_income total_other_income_expenses_net income_before_tax income_tax_expense
    net_income_from_continuing_operations net_income_from_discontinued_operations
    other_adjustments_to_net_income net_income net_income_deductions bottom_line_net_income
    eps eps_diluted weighted_average_shares_out weighted_average_shares_out_diluted
""".split()

BALANCE_AMOUNTS = """
    cash_and_cash_equivalents short_term_investments cash_and_short_term_investments
    net_receivables accounts_receivables other_receivables inventory prepaids
    other_current_assets total_current_assets property_plant_equipment_net goodwill
    intangible_assets goodwill_and_intangible_assets long_term_investments tax_assets
    other_non_current_assets total_non_current_assets other_assets total_assets
    total_payables account_payables other_payables accrued_expenses short_term_debt
    capital_lease_obligations_current tax_payables deferred_revenue
    other_current_liabilities total_current_liabilities long_term_debt
    deferred_revenue_non_current deferred_tax_liabilities_non_current
    other_non_current_liabilities total_non_current_liabilities other_liabilities
    capital_lease_obligations total_liabilities treasury_stock preferred_stock common_stock
    retained_earnings additional_paid_in_capital accumulated_other_comprehensive_income_loss
    other_total_stockholders_equity total_stockholders_equity total_equity minority_interest
    total_liabilities_and_total_equity total_investments total_debt net_debt
""".split()

CASH_FLOW_AMOUNTS = """
    net_income depreciation_and_amortization deferred_income_tax stock_based_compensation
    change_in_working_capital accounts_receivables inventory accounts_payables
    other_working_capital other_non_cash_items net_cash_provided_by_operating_activities
    investments_in_property_plant_and_equipment acquisitions_net purchases_of_investments
    sales_maturities_of_investments other_investing_activities
    net_cash_provided_by_investing_activities net_debt_issuance long_term_net_debt_issuance
    short_term_net_debt_issuance net_stock_issuance net_common_stock_issuance
    common_stock_issuance common_stock_repurchased net_preferred_stock_issuance
    net_dividends_paid common_dividends_paid preferred_dividends_paid
    other_financing_activities net_cash_provided_by_financing_activities
    effect_of_forex_changes_on_cash net_change_in_cash cash_at_end_of_period
    cash_at_beginning_of_period operating_cash_flow capital_expenditure free_cash_flow
    income_taxes_paid interest_paid
""".split()

PER_SHARE = {"eps", "eps_diluted"}  # the only amounts kept as floating point


def statement_schema(amounts: list[str]) -> T.StructType:
    fields = list(STATEMENT_HEAD.fields)
    fields += [T.StructField(a, T.DoubleType() if a in PER_SHARE else AMOUNT) for a in amounts]
    return T.StructType(fields + [T.StructField("extracted_at", T.TimestampNTZType())])


# ---------------------------------------------------------------------------
# Raw tables
# ---------------------------------------------------------------------------

PRICES = flat(
    "ticker string, open double, high double, low double, close double, volume bigint, "
    "vwap double, transactions bigint, date date, extracted_at timestamp_ntz"
)


def indicator_table(name: str) -> T.StructType:
    return flat(
        f"ticker string, timestamp timestamp_ntz, {name}_value double, window_size int, "
        "timespan string, series_type string, date date, extracted_at timestamp_ntz"
    )


RSI = indicator_table("rsi")
SMA = indicator_table("sma")

MACD = flat(
    "ticker string, timestamp timestamp_ntz, macd_value double, signal_value double, "
    "histogram_value double, short_window int, long_window int, signal_window int, "
    "timespan string, series_type string, date date, extracted_at timestamp_ntz"
)

NEWS = flat(
    "ticker string, article_id string, publisher_name string, publisher_homepage_url string, "
    "publisher_logo_url string, title string, author string, published_utc timestamp_ntz, "
    "article_url string, tickers variant, image_url string, description string, "
    "keywords variant, date date, extracted_at timestamp_ntz"
)

ARTICLES = flat(
    "ticker string, title string, date date, content string, article_tickers string, "
    "image_url string, article_url string, author string, site string, "
    "extracted_at timestamp_ntz"
)

CONSTITUENTS = flat(
    "ticker string, security_name string, gics_sector string, gics_sub_industry string, "
    "headquarters_location string, date_added date, cik string, founded_year string, "
    "date date, extracted_at timestamp_ntz"
)

INCOME = statement_schema(INCOME_AMOUNTS)
BALANCE = statement_schema(BALANCE_AMOUNTS)
CASH_FLOW = statement_schema(CASH_FLOW_AMOUNTS)

RAW_TABLES: dict[str, T.StructType] = {
    "tickers_lookup": CONSTITUENTS,
    "stock_prices": PRICES,
    "stock_prices_backfill": PRICES,
    "rsi": RSI,
    "rsi_backfill": RSI,
    "macd": MACD,
    "macd_backfill": MACD,
    "sma": SMA,
    "news": NEWS,
    "news_backfill": NEWS,
    "articles": ARTICLES,
    "income_statements": INCOME,
    "balance_sheets": BALANCE,
    "cash_flow_statements": CASH_FLOW,
}

# ---------------------------------------------------------------------------
# Landed feed files: one JSON object per request, the requested ticker included
# ---------------------------------------------------------------------------

PRICE_FEED = (
    "ticker string, status string, results array<struct<o double, h double, l double, "
    "c double, v double, vw double, n bigint, t bigint>>"
)

INDICATOR_FEED = (
    "ticker string, status string, "
    "results struct<values: array<struct<timestamp bigint, value double>>>"
)

MACD_FEED = (
    "ticker string, status string, results struct<values: array<struct<timestamp bigint, "
    "value double, signal double, histogram double>>>"
)

NEWS_FEED = (
    "ticker string, status string, results array<struct<id string, "
    "publisher struct<name string, homepage_url string, logo_url string>, title string, "
    "author string, published_utc string, article_url string, tickers array<string>, "
    "image_url string, description string, keywords array<string>>>"
)

ARTICLE_FEED = (
    "date string, tickers string, title string, content string, image string, link string, "
    "author string, site string"
)

REFERENCE_FEED = (
    "status string, results array<struct<ticker string, name string, market string, "
    "locale string, primary_exchange string, type string, active boolean, "
    "currency_name string, cik string>>"
)

# Header text of the constituents file and the columns it fills.
CONSTITUENT_HEADERS = {
    "Symbol": "ticker",
    "Security": "security_name",
    "GICS Sector": "gics_sector",
    "GICS Sub-Industry": "gics_sub_industry",
    "Headquarters Location": "headquarters_location",
    "Date added": "date_added",
    "CIK": "cik",
    "Founded": "founded_year",
}

CONSTITUENT_FEED = T.StructType(
    [T.StructField(header, T.StringType()) for header in CONSTITUENT_HEADERS]
)

# Feed names that do not follow the camelCase rule.
FEED_NAME_EXCEPTIONS = {
    "weighted_average_shares_out": "weightedAverageShsOut",
    "weighted_average_shares_out_diluted": "weightedAverageShsOutDil",
}


def feed_name(column: str) -> str:
    """Feed field behind a statement column: ``total_debt`` → ``totalDebt``."""
    head, *rest = column.split("_")
    return FEED_NAME_EXCEPTIONS.get(column, head + "".join(w.capitalize() for w in rest))


def statement_feed(amounts: list[str]) -> T.StructType:
    """One request: the ticker asked for and the statements returned."""
    record = [
        T.StructField(feed_name(f.name), T.StringType())
        for f in STATEMENT_HEAD
        if f.name != "ticker"
    ]
    record += [
        T.StructField(feed_name(a), T.DoubleType() if a in PER_SHARE else T.DecimalType(38, 6))
        for a in amounts
    ]
    return T.StructType(
        [
            T.StructField("ticker", T.StringType()),
            T.StructField("results", T.ArrayType(T.StructType(record))),
        ]
    )
