"""Incremental model builds end where a full build ends."""

import datetime as dt
import glob
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.operators.merge import recent_rows
from quotemill.operators.quality import QualityError
from quotemill.operators.semantic import query
from quotemill.operators.returns import price_returns
from quotemill.operators.state import history_state
from quotemill.plans import incremental
from quotemill.plans.build import MODELS, build, exposed
from quotemill.plans.history import STATE_TABLE, closed_before
from quotemill.sources.tables import Tables

START = dt.date(2022, 10, 17)
HOLIDAY = dt.date(2023, 1, 23)  # a Monday


def sessions(count):
    days, day = [], START
    while len(days) < count:
        if day.weekday() < 5 and day != HOLIDAY:
            days.append(day)
        day += dt.timedelta(days=1)
    return days


DAYS = sessions(75)


def row(schema, **values):
    return tuple(values.get(name) for name in schema.names)


def raw_rows():
    rng = random.Random(5)
    prices, rsi, macd = [], [], []
    for ticker in ("A", "B", "NEW"):
        close = 50.0
        days = DAYS if ticker != "NEW" else DAYS[-6:]
        if ticker == "B":  # thin trading: every third session only
            days = days[::3]
        for day in days:
            close = round(max(1.0, close * (1 + rng.uniform(-0.04, 0.041))), 2)
            prices.append(row(schemas.PRICES, ticker=ticker, date=day, close=close))
            rsi.append(row(schemas.RSI, ticker=ticker, date=day, rsi_value=rng.uniform(10, 90), window_size=14))
            macd.append(row(schemas.MACD, ticker=ticker, date=day, macd_value=rng.uniform(-1, 1), signal_value=0.1))
    return prices, rsi, macd


def store(spark, tables, upto):
    prices, rsi, macd = raw_rows()
    for name, schema, rows in (
        ("stock_prices", schemas.PRICES, prices), ("rsi", schemas.RSI, rsi), ("macd", schemas.MACD, macd)
    ):
        at = schema.names.index("date")
        df = spark.createDataFrame([r for r in rows if r[at] <= upto], schema)
        tables.overwrite(f"raw/{name}", df.coalesce(1))


def store_yearly(spark, tables):
    for name, schema in (
        ("income_statements", schemas.INCOME),
        ("balance_sheets", schemas.BALANCE),
        ("cash_flow_statements", schemas.CASH_FLOW),
    ):
        rows = [
            row(schema, ticker=t, date=dt.date(y, 12, 31), fiscal_year=str(y), period="FY")
            for t in ("A", "B") for y in (2021, 2022, 2023)
        ]
        tables.overwrite(f"raw/{name}", spark.createDataFrame(rows, schema))
    members = [
        row(schemas.CONSTITUENTS, ticker=t, security_name=t, gics_sector="S", date=d)
        for t, d in (("A", DAYS[0]), ("B", DAYS[0]), ("A", DAYS[1]))
    ]
    tables.overwrite("raw/tickers_lookup", spark.createDataFrame(members, schemas.CONSTITUENTS))


def contents(tables, name):
    rows = []
    for r in tables.read(MODELS[name].path).collect():
        values = {k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()}
        rows.append(repr(sorted(values.items())))
    return sorted(rows)


def test_incremental_build_equals_full_build(spark, tmp_path):
    step, whole = Tables(spark, str(tmp_path / "step")), Tables(spark, str(tmp_path / "whole"))
    for tables in (step, whole):
        store_yearly(spark, tables)
    # Full build, then a run for the next session and one across a weekend and a holiday.
    for last in (DAYS[-8], DAYS[-7], DAYS[-1]):
        store(spark, step, last)
        build(step)
    store(spark, whole, DAYS[-1])
    build(whole)
    for name in MODELS:
        assert contents(step, name) == contents(whole, name), name

    marts = exposed(step)
    assert len(marts) == 5
    left = query(marts, "industry_scores", ["ticker", "sector"], ["ticker_count"], order_by=["ticker"]).collect()
    assert [(r["ticker"], r["sector"]) for r in left] == [("A", "S"), ("B", None), ("NEW", None)]


def test_failed_check_stops_the_build(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    store_yearly(spark, tables)
    store(spark, tables, DAYS[30])
    bad = spark.createDataFrame([row(schemas.PRICES, date=DAYS[3], close=1.0)], schemas.PRICES)
    tables.append("raw/stock_prices", bad)
    with pytest.raises(QualityError, match="stock_prices: ticker"):
        build(tables)
    assert not tables.exists(MODELS["daily_price_changes"].path)
    warnings = []
    assert exposed(tables, warnings.append) == {} and len(warnings) == 5


def test_recent_rows_reach_back_for_thin_tickers_only(spark):
    rows = [("A", d) for d in DAYS] + [("B", d) for d in DAYS[::10]]
    df = spark.createDataFrame(rows, "ticker string, date date")
    since = DAYS[-2]
    recent = recent_rows(df, since, rows=5, days=10)
    counts = {r["ticker"]: r["count"] for r in recent.filter(F.col("date") < F.lit(since)).groupBy("ticker").count().collect()}
    assert counts["A"] < 15  # only the near days
    assert "B" not in counts or counts["B"] < 5  # B has no row since, so it is not filled up
    active = df.unionByName(spark.createDataFrame([("B", DAYS[-1])], df.schema))
    filled = recent_rows(active, since, rows=5, days=10)
    before = filled.filter((F.col("ticker") == "B") & (F.col("date") < F.lit(since)))
    assert before.count() == len([d for d in DAYS[::10] if d < since])


SPARSE = [dt.date(2019, 1, 1) + dt.timedelta(days=40 * i) for i in range(12)] + [dt.date(2023, 1, 2) + dt.timedelta(days=i) for i in range(8)]


def sparse_bars(spark, days, listed=()):
    rng = random.Random(3)
    rows = [(t, d, round(rng.uniform(5, 50), 2)) for d in SPARSE for t in ("A", "B")]
    rows += [("NEW", d, 7.0) for d in listed]
    return spark.createDataFrame([r for r in rows if r[1] in days], "ticker string, date date, close double")


def destroy(tables, table, before):
    """Make the files of old days unreadable."""
    folder = tables.path(f"{table}/data")
    hit = 0
    for file in glob.glob(f"{folder}/commit=*/date=*/*"):
        if file.split("date=")[1][:10] < before:
            with open(file, "wb") as f:
                f.write(b"gone")
            hit += 1
    assert hit


def test_incremental_runs_do_not_touch_closed_history(spark, tmp_path, monkeypatch):
    """With the stored state, a run reads recent days only: the old ones could be unreadable."""
    for model, span in incremental.LOOKBACKS.items():
        monkeypatch.setitem(incremental.LOOKBACKS, model, replace(span, rows=min(span.rows, 2)))
    tables = Tables(spark, str(tmp_path))
    tables.append("raw/p", sparse_bars(spark, SPARSE[:-3]), "date")
    since = SPARSE[-5]
    start = incremental.near_start(since, "price_returns")
    first = closed_before(tables, tables.read("raw/p"), ["raw/p"], start)
    assert {(r["ticker"], r["rows"], r["first_date"]) for r in first.collect()} == {("A", 12, SPARSE[0]), ("B", 12, SPARSE[0])}
    tables.append("raw/p", sparse_bars(spark, SPARSE[-3:], SPARSE[-2:]), "date")
    wanted = ["ticker", "date", "close", "daily_return", "cumulative_return", "running_max_price", "drawdown_pct"]
    whole = price_returns(tables.read("raw/p")).filter(F.col("date") >= F.lit(SPARSE[-3])).select(*wanted).collect()

    destroy(tables, "raw/p", "2022-01-01")
    with pytest.raises(Exception):
        price_returns(tables.read("raw/p")).collect()
    later = SPARSE[-3]
    closed = closed_before(tables, tables.read("raw/p"), ["raw/p"], incremental.near_start(later, "price_returns"))
    got = incremental.new_price_returns(tables.read("raw/p"), later, closed=closed).select(*wanted).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, whole))
    assert tables.manifest(STATE_TABLE).notes["through"] == str(incremental.near_start(later, "price_returns") - dt.timedelta(days=1))
    # A new listing has nothing older, and brings no old day into the plan.
    plan = incremental.new_price_changes(tables.read("raw/p"), later, closed=closed)
    assert plan.filter("ticker = 'NEW'").count() == 2


def test_state_is_made_anew_when_closed_days_change(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.append("raw/p", sparse_bars(spark, SPARSE), "date")
    closed = lambda day: closed_before(tables, tables.read("raw/p"), ["raw/p"], day)
    closed(SPARSE[8])
    kept = tables.manifest(STATE_TABLE).version
    assert closed(SPARSE[8]).count() == 2 and tables.manifest(STATE_TABLE).version == kept
    revised = spark.createDataFrame([("A", SPARSE[2], 999.0)], "ticker string, date date, close double")
    tables.replace_day("raw/p", revised, SPARSE[2])
    assert {r["ticker"]: (r["peak"], r["rows"]) for r in closed(SPARSE[8]).collect()}["A"] == (999.0, 8)
    # Carried on day by day, the state is that of all bars.
    for day in SPARSE[9:]:
        state = closed(day + dt.timedelta(days=1))
    assert sorted(map(repr, state.collect())) == sorted(map(repr, history_state(tables.read("raw/p")).collect()))


def test_thin_tickers_get_the_months_they_need_only(spark, monkeypatch):
    days = [dt.date(2020, 1, 15) + dt.timedelta(days=31 * k) for k in range(48)]
    rows = [("thin", d) for d in days] + [("one", days[0]), ("one", days[47])]
    df = spark.createDataFrame(rows, "ticker string, date date")
    for bound in (10, 0):
        monkeypatch.setattr("quotemill.operators.merge.BROADCAST_KEYS", bound)
        recent = sorted((r["ticker"], r["date"]) for r in recent_rows(df, days[47], rows=5, days=70, whole=False).collect())
        assert recent == sorted([("thin", d) for d in days[42:]] + [("one", days[0]), ("one", days[47])])
