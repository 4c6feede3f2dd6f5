"""Newest rows, merging, checks, companies and semantic queries."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from quotemill.operators import companies, merge, quality
from quotemill.operators.semantic import MODELS, from_rollup, query, rollup
from quotemill.operators.topk import latest_k
from quotemill import schemas
from quotemill.plans import latest, screens
from quotemill.plans.marts import Marts, staging

D = dt.date.fromisoformat


def test_latest_k_of_a_hot_key(spark):
    """One key with most rows gives the same rows whatever the number of shares."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("rare")).otherwise(F.lit("hot")).alias("ticker"),
        (F.col("id") % 977).alias("t"),
        "id",
    )
    order = [F.col("t").desc(), F.col("id").asc()]
    many = latest_k(df, 7, order, ["id"], salts=50)
    one = latest_k(df, 7, order, ["id"], salts=1)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
    assert many.count() == 14


def test_latest_k_ranks_before_every_shuffle(spark):
    df = spark.range(10).select(F.lit("a").alias("ticker"), "id")
    plan = latest_k(df, 2, [F.col("id").desc()], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, date date, v int")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_delete_insert(spark):
    target = frame(spark, [("a", D("2024-01-01"), 1), ("a", D("2024-01-02"), 1), (None, D("2024-01-02"), 1)])
    batch = frame(spark, [("a", D("2024-01-02"), 2), ("a", D("2024-01-02"), 3), (None, D("2024-01-02"), 2)])
    merged = merge.delete_insert(target, batch, ["k", "date"])
    assert sorted(r[2] for r in content(merged)) == [1, 1, 2, 2, 3]


def test_replace_range(spark):
    existing = frame(spark, [("a", D("2024-01-01"), 1), ("a", D("2024-01-02"), 1), ("a", None, 1)])
    result = merge.replace_range(existing, frame(spark, []), "2024-01-01", "2024-01-01")
    assert content(result) == content(existing.filter("date is null or date = '2024-01-02'"))
    assert merge.date_bounds(existing) == (D("2024-01-01"), D("2024-01-02"))
    assert merge.date_bounds(frame(spark, [])) == (None, None)


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", D("2024-01-01"), 0), ("a", D("2024-01-02"), 100), ("b", None, 101), ("c", None, -1), (None, None, None)],
        "ticker string, date date, score int",
    )
    assert quality.null_rows(df, "ticker").count() == 1
    assert content(quality.repeated_keys(df, "ticker")) == [("a", 2)]
    assert {r["score"] for r in quality.score_out_of_range(df, "score").collect()} == {101, -1, None}
    quality.require_empty(df.filter("false"), "nothing")
    with pytest.raises(quality.QualityError):
        quality.require_empty(df, "something")


LOOKUP = """ticker string, security_name string, gics_sector string, gics_sub_industry string,
    headquarters_location string, date_added date, cik string, founded_year string, date date,
    extracted_at timestamp_ntz"""


def lookup(spark):
    def member(ticker, day, sector="S"):
        return (ticker, f"n{ticker}", sector, "I", "L", D("2001-02-03"), "1", "1950", D(day), None)

    return spark.createDataFrame(
        [member("a", "2024-01-01"), member("b", "2024-01-01"), member("a", "2024-01-02", "S2"),
         member(None, "2024-01-02"), member("a", "2024-01-02", "S2")],
        LOOKUP,
    )


def test_companies(spark):
    current = companies.companies_current(companies.companies_snapshot(lookup(spark)))
    assert {(r["ticker"], r["sector"], r["date_added_year"]) for r in current.collect()} == {
        ("a", "S2", 2001), (None, "S", 2001)
    }
    assert content(companies.universe(lookup(spark), "2024-01-02")) == [("a",)]
    assert content(companies.universe(lookup(spark), "2024-01-01")) == [("a",), ("b",)]
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "ticker string, v int")
    joined = companies.with_company(rows, current.filter("ticker is not null").dropDuplicates())
    assert {(r["v"], r["sector"]) for r in joined.collect()} == {(1, "S2"), (2, None), (3, None)}


def test_staging_with_backfill(spark):
    ddl = "ticker string, date date, close double, extracted_at timestamp_ntz"
    daily = spark.createDataFrame([("a", D("2024-01-02"), 1.0, None)], ddl)
    older = spark.createDataFrame([("a", D("2024-01-02"), 9.0, None), ("a", D("2024-01-01"), 2.0, None)], ddl)
    raw = {"stock_prices": daily, "stock_prices_backfill": older}
    assert content(staging(raw, "stock_prices")) == [("a", D("2024-01-02"), 1.0)]
    both = staging(raw, "stock_prices", include_backfill=True)
    assert content(both) == [("a", D("2024-01-01"), 2.0), ("a", D("2024-01-02"), 1.0)]


def performance(spark):
    rows = [
        ("a", "A", "tech", "i", "2024-01-01", 1.0, None, 0.0, None, None, None, None, 1.0, 0.0),
        ("a", "A", "tech", "i", "2024-01-02", 2.0, 1.0, 1.0, 0.2, 0.2, 0.4, 0.2, 2.0, 0.0),
        ("a", "A", "tech", "i", "2024-02-02", 1.0, -0.5, 0.0, -0.2, 0.1, 0.6, 0.3, 2.0, -0.5),
        ("b", "B", None, "i", "2024-02-02", 3.0, 0.0, 0.5, 0.1, 0.1, -0.1, 0.0, 3.0, 0.0),
    ]
    return spark.createDataFrame(
        [r[:4] + (D(r[4]),) + r[5:] for r in rows],
        """ticker string, company_name string, sector string, industry string, date date, close double,
        daily_return double, cumulative_return double, rolling_30d_return double, rolling_90d_return double,
        rolling_1y_return double, rolling_30d_volatility double, running_max_price double, drawdown_pct double""",
    )


def test_price_measures(spark):
    tables = {"price_performance": performance(spark)}
    measures = list(MODELS["price_performance"].measures)
    tech = query(tables, "price_performance", ["sector"], measures, filters={"sector": "tech"}).first()
    assert tech["positive_return_rate"] == 0.5 and tech["avg_daily_return"] == 0.25
    assert tech["avg_risk_adjusted_return"] == pytest.approx(2.0)
    assert tech["avg_return_to_drawdown"] == pytest.approx(1.2)  # a zero drawdown does not count
    assert (tech["latest_close"], tech["max_drawdown"]) == (2.0, -0.5)
    assert (tech["ticker_count"], tech["observation_count"]) == (1, 3)
    other = query(tables, "price_performance", [], ["avg_risk_adjusted_return", "ticker_count"], filters=["sector is null"])
    assert tuple(other.first()) == (None, 1)


def test_query_options(spark):
    tables = {"price_performance": performance(spark)}

    def ask(*arguments, **options):
        return content(query(tables, "price_performance", *arguments, **options))

    assert ask(["date"], ["observation_count"], time_grain="month") == [(D("2024-01-01"), 2), (D("2024-02-01"), 2)]
    assert ask(["ticker"], ["latest_close"], order_by=["-latest_close"], limit=1) == [("b", 3.0)]
    assert ask(["sector"]) == [("tech",), (None,)]
    assert ask(["ticker"], ["latest_close"], latest=True) == [("a", 1.0), ("b", 3.0)]
    assert ask(["ticker"], ["latest_close"], filters=[F.col("close") > 5]) == []
    assert ask([], ["ticker_count"], approximate=True) == [(2,)]
    for wrong in (
        dict(dimensions=["colour"]),
        dict(measures=["avg_colour"]),
        dict(),
        dict(dimensions=["date"], time_grain="hour"),
    ):
        with pytest.raises(ValueError):
            query(tables, "price_performance", **wrong)
    with pytest.raises(ValueError):
        query(tables, "colours", ["ticker"])
    with pytest.raises(ValueError):
        query(tables, "technical_scores", ["ticker"])


def test_measure_counts():
    assert {name: len(model.measures) for name, model in MODELS.items()} == {
        "technical_scores": 10, "fundamental_scores": 16, "composite_scores": 10, "industry_scores": 10,
        "price_performance": 15,
    }


def test_pattern_screens(spark):
    marts = {"price_performance": performance(spark)}
    assert [r["ticker"] for r in screens.momentum(marts).collect()] == ["a"]
    assert [str(r["date"]) for r in screens.mean_reversion(marts).collect()] == ["2024-02-02"]
    assert {r["ticker"] for r in screens.regime_shift(marts).collect()} == {"a", "b"}
    assert screens.risk_off(marts, volatility=0.25).count() == 1
    assert [r["ticker"] for r in screens.near_high(marts).collect()] == ["b"]
    with pytest.raises(ValueError):
        screens.rank_by_composite({}, "best")


# -- plans --------------------------------------------------------------------


@pytest.fixture
def hot(spark):
    """A third of all rows in one ticker."""
    ticker = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
    return spark.range(0, 60_000, 1, 8).select(ticker.alias("ticker"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


@pytest.fixture
def small_thresholds(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_membership_join_of_few_members_shuffles_nothing(spark, hot, small_thresholds):
    members = hot.select("ticker").distinct()
    assert shuffles(companies.in_universe(hot, members)) == 1  # of the members themselves


def test_membership_join_spreads_a_hot_ticker(spark, hot, small_thresholds, monkeypatch):
    members = hot.select("ticker").distinct()
    monkeypatch.setattr(companies, "BROADCAST_MEMBERS", 0)
    with pytest.raises(ValueError):
        companies.in_universe(hot, members, shares=16)
    joined = companies.in_universe(hot, members, shares=16, spread=[c for c in hot.columns if c != "ticker"])
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 10_000
    assert companies.in_universe(hot, members.filter("ticker = 'HOT'")).count() == 20_000
    assert companies.in_universe(hot.select("ticker"), members).count() == 60_000


def test_dimension_join_splits_a_hot_ticker(spark, hot, small_thresholds):
    names = hot.filter("ticker <> 'HOT'").select("ticker").union(spark.createDataFrame([("HOT",)], "ticker string"))
    joined = companies.with_company(hot, names.selectExpr("ticker", "'n' company_name", "'s' sector", "'i' industry"))
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_price_windows_share_one_shuffle(spark):
    from quotemill.operators.indicators import macd, moving_averages
    from quotemill.operators.returns import price_returns

    prices = spark.createDataFrame([("a", D("2024-01-01"), 1.0)], "ticker string, date date, close double")
    for result in (price_returns(prices), moving_averages(prices), macd(prices)):
        assert shuffles(result) == 1


def test_scores_need_one_shuffle_per_input(spark):
    """Joins on ticker and day reuse the partitioning of the windows: no further shuffle."""
    from quotemill.operators.composite import composite_scores
    from quotemill.operators.indicators import technical_indicators
    from quotemill.operators.scoring import technical_scores

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prices = spark.createDataFrame([("a", D("2024-01-01"), 1.0)], "ticker string, date date, close double")
        rsi = spark.createDataFrame([], "ticker string, date date, rsi_value double, window_size int, timespan string, series_type string")
        macd = spark.createDataFrame([], "ticker string, date date, macd_value double, signal_value double, histogram_value double")
        # The empty sides must not be optimized away.
        technical = technical_scores(technical_indicators(prices, rsi.union(rsi.repartition(1)), macd.union(macd.repartition(1))))
        assert shuffles(technical) <= 3
        fundamental = spark.createDataFrame(
            [("a", D("2023-12-31"), "2023", 1, 1, 1, 1, 1)],
            "ticker string, date date, fiscal_year string, fundamentals_score int, profitability_score int, "
            "growth_score int, financial_health_score int, cash_quality_score int",
        )
        assert shuffles(composite_scores(technical, fundamental)) == shuffles(technical) + 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_older_bars_are_hashed_not_sorted(spark):
    from quotemill.operators.returns import price_returns

    prices = spark.createDataFrame([("a", D("2024-01-01"), 1.0)], "ticker string, date date, close double")
    plan = price_returns(prices, earlier=prices)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_staging_views(spark):
    from quotemill.plans.marts import create_views

    ddl = "ticker string, date date, close double, extracted_at timestamp_ntz"
    raw = {"stock_prices": spark.createDataFrame([("a", D("2024-01-02"), 1.0, None)], ddl)}
    create_views(raw, ["stock_prices"])
    assert content(spark.sql("select * from stg_stock_prices")) == [("a", D("2024-01-02"), 1.0)]


def test_every_model_is_described():
    from quotemill.operators.semantic import MODELS, describe

    rows = describe()
    assert {r["model"] for r in rows} == set(MODELS)
    named = {(r["model"], r["name"]) for r in rows}
    assert named == {(m, n) for m, spec in MODELS.items() for n in (*spec.dimensions, *spec.measures)}
    assert all(r["meaning"] and r["about"] for r in rows)
    assert describe("technical_scores") == [r for r in rows if r["model"] == "technical_scores"]
    with pytest.raises(ValueError):
        describe("none")


@pytest.mark.parametrize("grain", ["month", "quarter", "year"])
def test_rollups_merge_to_the_direct_results(spark, grain):
    """All measures of a model, from states of months, by several sets of dimensions."""
    rows = spark.range(3000).select(
        (F.col("id") % 7).cast("string").alias("ticker"),
        F.concat(F.lit("n"), F.col("id") % 7).alias("company_name"),
        F.when(F.col("id") % 7 < 5, F.concat(F.lit("s"), F.col("id") % 2)).alias("sector"),
        F.lit("i").alias("industry"),
        F.date_add(F.lit("2022-11-20").cast("date"), (F.col("id") % 600).cast("int")).alias("date"),
        *[
            F.when((F.col("id") * k) % 11 > 0, ((F.col("id") * k) % 101 - 40) / 10).alias(name)
            for k, name in enumerate(
                """close daily_return cumulative_return rolling_30d_return rolling_90d_return rolling_1y_return
                rolling_30d_volatility drawdown_pct""".split(), 3
            )
        ],
    )
    tables, model = {"price_performance": rows}, "price_performance"
    rolled = rollup(rows, model, ["ticker", "sector"]).cache()
    measures = list(MODELS[model].measures)
    for dimensions in ([], ["sector"], ["date"], ["ticker", "date"]):
        direct = query(tables, model, dimensions, measures, time_grain=grain).collect()
        merged = from_rollup(rolled, model, dimensions, measures, grain).collect()
        key = lambda r: repr([r[d] for d in dimensions])
        expected = {key(r): r for r in direct}
        assert len(merged) == len(direct) and {key(r) for r in merged} == set(expected)
        for row in merged:
            for name in measures:
                assert row[name] == pytest.approx(expected[key(row)][name], rel=1e-9, abs=1e-9), name


def test_spread_of_rollups(spark):
    rows = spark.range(500).selectExpr(
        "string(id % 3) AS ticker", "date_add(date'2024-01-01', int(id % 90)) AS date", "int(id * 37 % 101) AS technical_score",
        "1 AS trend_score", "2 AS momentum_score", "3 AS price_action_score", "4 AS macd_score"
    ).unionByName(spark.sql("SELECT 'x' AS ticker, date'2024-01-01' AS date, 5 AS technical_score, 1 AS trend_score, 2 AS momentum_score, 3 AS price_action_score, 4 AS macd_score"))
    measures = ["std_technical_score", "avg_technical_score", "ticker_count"]
    rolled = rollup(rows, "technical_scores", ["ticker"])
    direct = {r["ticker"]: r for r in query({"technical_scores": rows}, "technical_scores", ["ticker"], measures).collect()}
    for row in from_rollup(rolled, "technical_scores", ["ticker"], measures).collect():
        for name in measures:
            assert row[name] == pytest.approx(direct[row["ticker"]][name])
    assert direct["x"]["std_technical_score"] is None
    with pytest.raises(ValueError):
        from_rollup(rolled, "technical_scores", ["ticker"], measures, "week")
    with pytest.raises(ValueError):
        rollup(rows, "technical_scores", ["date"])
    with pytest.raises(ValueError):
        from_rollup(rolled, "technical_scores", ["sector"], measures)


LATEST = {
    "strong_now": latest.SCORE_ROWS,
    "momentum_leaders": latest.SCORE_ROWS,
    "rank_by_composite": latest.SCORE_ROWS,
    "near_high": latest.RETURN_ROWS,
}


def bars_of(rows):
    """Bars, RSI and MACD points, and yearly statements."""
    spark = rows.sparkSession
    empty = {name: spark.createDataFrame([], schema) for name, schema in schemas.RAW_TABLES.items()}
    points = {
        "rsi": rows.select("ticker", "date", (F.col("close") % 100).alias("rsi_value"), F.lit(14).alias("window_size"), F.lit("day").alias("timespan"), F.lit("close").alias("series_type")),
        "macd": rows.select("ticker", "date", (F.col("close") - 50).alias("macd_value"), F.lit(0.5).alias("signal_value"), F.lit(0.1).alias("histogram_value")),
    }
    return empty | points | {"stock_prices": rows}


@pytest.mark.parametrize("not_after", [None, "2023-02-20"])
@pytest.mark.parametrize("name", list(LATEST))
def test_latest_day_from_recent_bars_alone(spark, tmp_path, name, not_after):
    """The same rows as from all of history, and a filter on days in the scans."""
    path = str(tmp_path / "bars")
    day = F.date_sub(F.lit("2023-03-31").cast("date"), (F.col("id") % 700).cast("int"))
    thin = (F.col("id") % 3 > 0) | (F.col("id") % 700 % 5 == 0)
    rows = spark.range(2100).filter(thin).select(
        F.concat(F.lit("T"), F.col("id") % 3).alias("ticker"), day.alias("date"), ((F.col("id") * 7919) % 9000 / 100 + 1).alias("close")
    )
    rows.dropDuplicates(["ticker", "date"]).write.parquet(path)
    raw = bars_of(spark.read.parquet(path))
    screen = getattr(screens, name)
    options = {"not_after": not_after} | ({"within": 1.0} if name == "near_high" else {})
    whole = screen(Marts(raw).exposed(), **options)
    recent = screen(latest.latest(raw, LATEST[name], not_after).exposed(), **options)
    assert whole.count() > 0 and content(recent) == content(whole)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in re.findall(r"PushedFilters: \[([^\]]*)\]", plan)]
    assert scans and all("(date," in x for x in scans)


def test_latest_day_without_bars(spark):
    raw = bars_of(spark.createDataFrame([], "ticker string, date date, close double"))
    assert screens.strong_now(latest.latest(raw).exposed()).count() == 0
    index = latest.listing(raw["stock_prices"])
    assert latest.first_day(index, 10) is None


def test_daily_rows_are_not_shuffled_for_few_companies(spark, hot, small_thresholds, monkeypatch):
    from quotemill.operators import composite

    names = spark.createDataFrame([("HOT", "n", "s", "i")], "ticker string, company_name string, sector string, industry string")
    joined = composite.price_performance(hot, names)
    assert shuffles(joined) == 0
    assert joined.filter("sector = 's'").count() == 20_000 and joined.count() == 60_000
    monkeypatch.setattr(companies, "BROADCAST_COMPANIES", 0)
    beyond = composite.price_performance(hot, names)
    assert shuffles(beyond) > 0 and beyond.filter("sector = 's'").count() == 20_000


def test_names_of_recent_rows_are_not_broadcast(spark, hot, small_thresholds):
    """The driver need not hold all companies for a few days."""
    from quotemill.operators import composite

    names = spark.createDataFrame([("HOT", "n", "s", "i")], "ticker string, company_name string, sector string, industry string")
    recent = composite.price_performance(hot, names, recent=True)
    assert "Broadcast" not in recent._jdf.queryExecution().executedPlan().toString()
    assert recent.filter("sector = 's'").count() == 20_000 and recent.count() == 60_000


def test_names_of_many_scored_companies_are_not_broadcast(spark, small_thresholds, monkeypatch):
    from quotemill.operators import composite

    days = "ticker string, technical_date date, technical_score int, fundamentals_score int, fiscal_year string"
    days += ", fiscal_year_start_date date, fiscal_year_end_date date, " + ", ".join(f"{c} double" for c in composite.WEIGHTS)
    rows = spark.createDataFrame([(t, *[None] * 9) for t in ("A", "B", None, "A")], days)
    names = spark.createDataFrame([(t, "n", "s", "i") for t in ("A", "C")], "ticker string, company_name string, sector string, industry string")
    for most, found in ((2, True), (1, False)):
        monkeypatch.setattr(composite, "SCORED_COMPANIES", most)
        scored = composite.industry_scores(rows, names)
        assert ("BroadcastHashJoin" in scored._jdf.queryExecution().executedPlan().toString()) == found
        assert sorted(str(r["company_name"]) for r in scored.collect()) == ["None", "None", "n", "n"]
