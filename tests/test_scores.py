"""One row per branch of every point scale, boundary values, ratios, growth and composite."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.operators import composite, fundamentals, scoring

D = dt.date.fromisoformat


def values(spark, ddl, rows, expression):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_trend(spark):
    rows = [(10.0, 9.0, 9.0, 9.0), (10.0, 9.0, 9.0, 10.0), (10.0, 9.0, 10.0, 9.0), (10.0, 10.0, 9.0, 9.0),
            (10.0, 10.0, 10.0, 9.0), (10.0, None, None, None), (None, 1.0, 1.0, 1.0)]
    ddl = "close double, sma_20 double, sma_50 double, sma_200 double"
    assert values(spark, ddl, rows, scoring.trend_score()) == [40, 30, 20, 10, 5, 5, 5]


def test_momentum(spark):
    rows = [(50.0,), (70.0,), (40.0,), (75.0,), (80.0,), (80.01,), (30.0,), (39.99,), (29.99,), (None,)]
    expected = [30, 30, 20, 20, 20, 15, 10, 10, 5, 15]
    assert values(spark, "rsi_value double", rows, scoring.momentum_score()) == expected


def test_macd(spark):
    rows = [(2.0, 1.0), (-1.0, -2.0), (0.0, -1.0), (-2.0, -1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)]
    ddl = "macd_value double, macd_signal double"
    assert values(spark, ddl, rows, scoring.macd_score()) == [10, 7, 7, 3, 5, 5, 5]


def test_price_action(spark):
    rows = [(10.01,), (10.0,), (5.0,), (0.01,), (0.0,), (-4.99,), (-5.0,), (None,)]
    expected = [20, 15, 10, 10, 5, 5, 0, 0]
    assert values(spark, "x double", rows, scoring.price_action_score("x")) == expected


RATIOS = "gross_margin decimal(38,6), operating_margin decimal(38,6), net_margin decimal(38,6), return_on_equity decimal(38,6)"


def dec(*texts):
    return tuple(None if t is None else Decimal(t) for t in texts)


def test_profitability(spark):
    rows = [
        dec("0.500001", "0.250001", "0.200001", "0.200001"),
        dec("0.500000", "0.300000", "0.300000", "0.200000"),
        dec("0.400000", "0.250000", "0.250000", "0.150000"),
        dec("0.300000", "0.160000", "0.110000", "0.100000"),
        dec("0.200000", "0.200000", "0.100000", "0"),
        dec("0.100000", None, "0", "-0.1"),
        dec(None, None, None, None),
    ]
    assert values(spark, RATIOS, rows, scoring.profitability_score()) == [25, 19, 14, 8, 3, 0, 0]


def test_growth(spark):
    ddl = "revenue_growth_yoy decimal(38,6), eps_growth_yoy double, fcf_growth_yoy decimal(38,6)"

    def row(text):
        return (Decimal(text), float(text), Decimal(text))

    rows = [row(t) for t in ("0.26", "0.25", "0.20", "0.15", "0.10", "0.05", "0.01", "0", "-1")]
    expected = [30, 28, 24, 18, 12, 6, 6, 0, 0]
    assert values(spark, ddl, rows + [(None, None, None)], scoring.growth_score()) == expected + [0]


def test_financial_health(spark):
    ddl = "current_ratio decimal(38,6), debt_to_equity decimal(38,6), fcf_margin decimal(38,6)"
    rows = [
        dec("2.000001", "0.299999", "0.250001"),
        dec("2.0", "0.3", "0.25"),
        dec("1.5", "0.5", "0.20"),
        dec("1.0", "1.0", "0.15"),
        dec("0.75", "2.0", "0.10"),
        dec(None, None, None),
        dec("3", "-1", "1"),
    ]
    expected = [25, 20, 15, 10, 5, 5, 25]
    assert values(spark, ddl, rows, scoring.financial_health_score()) == expected


def test_cash_quality(spark):
    ddl = "fcf_to_net_income decimal(38,6), fcf_margin decimal(38,6)"
    rows = [dec("1.21", "0.21"), dec("1.2", "0.2"), dec("1.0", "0.15"), dec("0.8", "0.1"), dec("0.5", None), dec(None, None)]
    assert values(spark, ddl, rows, scoring.cash_quality_score()) == [20, 16, 12, 8, 5, 5]


def test_technical_score_uses_the_close_twenty_rows_before(spark):
    ddl = ("ticker string, date date, close double, sma_20 double, sma_50 double, sma_200 double, "
           "rsi_value double, macd_value double, macd_signal double")
    start = D("2024-01-01")
    rows = [("A", start + dt.timedelta(days=i), 100.0 + i, 1.0, 1.0, 1.0, 60.0, 2.0, 1.0) for i in range(21)]
    scored = scoring.technical_scores(spark.createDataFrame(rows, ddl)).orderBy("date").collect()
    assert [r["price_action_score"] for r in scored] == [0] * 20 + [20]
    assert scored[-1]["technical_score"] == 100 and scored[0]["technical_score"] == 80


# -- statements ---------------------------------------------------------------


def statements(spark, income, balance, cash):
    """Frames with the named columns; all other statement columns are NULL."""

    def frame(schema, rows):
        names = [f.name for f in schema]
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)

    return (
        frame(schemas.INCOME, income),
        frame(schemas.BALANCE, balance),
        frame(schemas.CASH_FLOW, cash),
    )


def head(year, period="FY", ticker="A"):
    return {"ticker": ticker, "date": D(f"{year}-12-31"), "fiscal_year": str(year), "period": period}


def test_statement_join(spark):
    income, balance, cash = statements(
        spark,
        [head(2020) | {"revenue": Decimal(1)}, head(2021, "Q4"), head(2022)],
        [head(2020, "FY"), head(2020, "Q4"), head(2021), {**head(2022), "fiscal_year": "2021"}],
        [head(2020), head(2021), head(2022)],
    )
    joined = fundamentals.join_statements(income, balance, cash).collect()
    assert [(r["fiscal_year"], r["revenue"]) for r in joined] == [("2020", 1), ("2020", 1)]


def test_ratio_guards_and_rounding(spark):
    income, balance, cash = statements(
        spark,
        [head(2020) | {"revenue": Decimal(10_000_000), "gross_profit": Decimal(5_000_004), "net_income": Decimal(-5)},
         head(2021) | {"revenue": Decimal(0), "gross_profit": Decimal(1)},
         head(2022) | {"gross_profit": Decimal(1)}],
        [head(y) | {"total_current_liabilities": Decimal(3), "cash_and_short_term_investments": Decimal(1),
                    "net_receivables": Decimal(1), "total_stockholders_equity": Decimal(-4), "total_debt": Decimal(4)}
         for y in (2020, 2021, 2022)],
        [head(y) | {"free_cash_flow": Decimal(7)} for y in (2020, 2021, 2022)],
    )
    first, second, third = fundamentals.fundamentals(income, balance, cash).orderBy("date").collect()
    assert first["gross_margin"] == Decimal("0.500000") and first["quick_ratio"] == Decimal("0.666667")
    assert first["fcf_to_net_income"] is None and first["debt_to_equity"] is None
    assert second["gross_margin"] is None and third["gross_margin"] is None
    assert first["revenue_growth_yoy"] is None and second["revenue_growth_yoy"] == Decimal("-1.000000")
    assert third["revenue_growth_yoy"] is None


def test_growth_needs_a_positive_base(spark):
    incomes = {2018: -5, 2019: 10, 2020: None, 2021: 4, 2022: 5}
    years = list(incomes)
    income, balance, cash = statements(
        spark,
        [head(y) | {"net_income": None if v is None else Decimal(v), "eps_diluted": None if v is None else v / 10}
         for y, v in incomes.items()],
        [head(y) for y in years],
        [head(y) for y in years],
    )
    rows = fundamentals.fundamentals(income, balance, cash).orderBy("date").collect()
    assert [r["net_income_growth_yoy"] for r in rows] == [None, None, None, None, Decimal("0.250000")]
    assert [r["eps_growth_yoy"] for r in rows][:4] == [None] * 4
    scores = scoring.fundamental_scores(fundamentals.fundamentals(income, balance, cash))
    assert scores.orderBy("date").first()["fundamentals_score"] == 10


# -- composite ----------------------------------------------------------------


def composite_rows(spark, matching):
    technical = spark.createDataFrame(
        [("A", D(d), 70, 1, 1, 1, 1) for d in ("2019-06-30", "2020-12-31", "2021-06-30", "2021-12-31", "2022-03-01")]
        + [("B", D("2021-06-30"), 50, 1, 1, 1, 1)],
        "ticker string, date date, technical_score int, trend_score int, momentum_score int, macd_score int, "
        "price_action_score int",
    )
    fundamental = spark.createDataFrame(
        [("A", D(f"{y}-12-31"), str(y), s, 1, 1, 1, 1) for y, s in ((2019, 40), (2020, 60), (2021, 81))],
        "ticker string, date date, fiscal_year string, fundamentals_score int, profitability_score int, "
        "growth_score int, financial_health_score int, cash_quality_score int",
    )
    rows = composite.composite_scores(technical, fundamental, matching).collect()
    return sorted(((r["ticker"], str(r["technical_date"]), r["fiscal_year"], r["composite_score_technical_bias"]) for r in rows), key=repr)


def test_year_end_belongs_to_two_years(spark):
    assert composite_rows(spark, "inclusive") == [
        ("A", "2019-06-30", None, None),
        ("A", "2020-12-31", "2020", Decimal("66.0")),
        ("A", "2020-12-31", "2021", Decimal("74.4")),
        ("A", "2021-06-30", "2021", Decimal("74.4")),
        ("A", "2021-12-31", "2021", Decimal("74.4")),
        ("A", "2022-03-01", None, None),
        ("B", "2021-06-30", None, None),
    ]


def test_half_open_and_asof(spark):
    half_open = [r[:3] for r in composite_rows(spark, "half_open")]
    assert ("A", "2020-12-31", "2020") in half_open and ("A", "2020-12-31", "2021") not in half_open
    assert [r[2] for r in composite_rows(spark, "asof")] == [None, "2020", "2020", "2021", "2021", None]
    with pytest.raises(ValueError):
        composite_rows(spark, "nearest")
