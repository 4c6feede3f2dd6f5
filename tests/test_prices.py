"""Returns, averages and recursive indicators against plain Python, whole and split."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.operators import indicators
from quotemill.operators.recursion import Macd, WilderRsi
from quotemill.operators.returns import daily_price_changes, price_returns
from quotemill.operators.timeline import Split

SCHEMA = schemas.flat("ticker string, date date, close double")
START = dt.date(2020, 1, 1)
BLOCKS = Split(rows_per_block=300, piece="month")


def bars(spark, **closes):
    rows = [
        (ticker, START + dt.timedelta(days=i), value)
        for ticker, values in closes.items()
        for i, value in enumerate(values)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def walk(n, seed=7):
    rng, price, out = random.Random(seed), 100.0, []
    for _ in range(n):
        price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
        out.append(round(price, 2))
    return out


def column(df, name, ticker="A"):
    rows = df.filter(F.col("ticker") == ticker).orderBy("date").select(name).collect()
    return [r[0] for r in rows]


def close_to(actual, expected, tolerance=1e-9):
    assert len(actual) == len(expected)
    for a, e in zip(actual, expected):
        assert (a is None) == (e is None), (a, e)
        assert a is None or math.isclose(a, e, rel_tol=tolerance, abs_tol=1e-9), (a, e)


def lagged(values, k):
    return [values[i] / values[i - k] - 1 if i >= k else None for i in range(len(values))]


@pytest.mark.parametrize("split", [None, BLOCKS])
def test_returns(spark, split):
    values = walk(1000)
    result = price_returns(bars(spark, A=values, B=[5.0]), split).cache()
    close_to(column(result, "daily_return"), lagged(values, 1))
    close_to(column(result, "cumulative_return"), [v / values[0] - 1 for v in values])
    close_to(column(result, "rolling_30d_return"), lagged(values, 30))
    close_to(column(result, "rolling_90d_return"), lagged(values, 90))
    close_to(column(result, "rolling_1y_return"), lagged(values, 252))
    peaks = [max(values[: i + 1]) for i in range(len(values))]
    close_to(column(result, "running_max_price"), peaks)
    close_to(column(result, "drawdown_pct"), [v / p - 1 for v, p in zip(values, peaks)])
    daily = lagged(values, 1)
    spread = []
    for i in range(len(values)):
        frame = [d for d in daily[max(0, i - 29) : i + 1] if d is not None]
        spread.append(statistics.stdev(frame) if len(frame) > 1 else None)
    close_to(column(result, "rolling_30d_volatility"), spread)
    assert result.count() == 1001
    single = result.filter("ticker = 'B'").first()
    assert single["daily_return"] is None and single["rolling_30d_volatility"] is None
    assert single["cumulative_return"] == 0 and single["drawdown_pct"] == 0


@pytest.mark.parametrize("split", [None, BLOCKS])
def test_null_and_zero_closes(spark, split):
    result = price_returns(bars(spark, A=[None, 10.0, 0.0, 5.0], B=[2.0, 3.0]), split).cache()
    assert column(result, "cumulative_return") == [None] * 4
    assert column(result, "daily_return") == [None, None, -1.0, None]
    assert column(result, "running_max_price") == [None, 10.0, 10.0, 10.0]


@pytest.mark.parametrize("split", [None, BLOCKS])
def test_price_changes(spark, split):
    result = daily_price_changes(bars(spark, A=[10.0, 12.5, 11.0]), split).cache()
    assert column(result, "previous_day_close") == [None, 10.0, 12.5]
    assert column(result, "price_change") == [None, 2.5, -1.5]


@pytest.mark.parametrize("split", [None, BLOCKS])
def test_averages_round_half_up_exactly(spark, split):
    values = walk(700)
    result = indicators.moving_averages(bars(spark, A=values), digits=2, split=split).cache()
    cents = [round(v * 100) for v in values]
    for name, n in indicators.SMA_WINDOWS.items():
        expected = []
        for i in range(len(cents)):
            frame = cents[max(0, i - n + 1) : i + 1]
            expected.append((2 * sum(frame) + len(frame)) // (2 * len(frame)) / 100)
        assert column(result, name) == expected
    half_cent = indicators.moving_averages(bars(spark, A=[1.0, 1.01]), {"sma_2": 2}, digits=2)
    assert column(half_cent, "sma_2") == [1.0, 1.01]


def test_averages_skip_null_closes(spark):
    result = indicators.moving_averages(bars(spark, A=[None, 2.0, None, 4.0]), {"sma_3": 3}).cache()
    assert column(result, "sma_3") == [None, 2.0, 2.0, 3.0]


def ema(values, span):
    out = []
    for v in values:
        out.append(v if not out else out[-1] + (v - out[-1]) * 2 / (span + 1))
    return out


@pytest.mark.parametrize("split", [None, Split(rows_per_block=1000, piece="quarter")])
def test_macd(spark, split):
    values = walk(3000)
    result = indicators.macd(bars(spark, A=values), split=split).cache()
    line = [a - b for a, b in zip(ema(values, 12), ema(values, 26))]
    signal = ema(line, 9)
    close_to(column(result, "macd_value"), line, 1e-7)
    close_to(column(result, "signal_value"), signal, 1e-7)
    close_to(column(result, "histogram_value"), [a - b for a, b in zip(line, signal)], 1e-6)


def test_macd_with_other_windows(spark):
    values = walk(600)
    result = indicators.macd(bars(spark, A=values), short_window=1, long_window=2, signal_window=3).cache()
    close_to(column(result, "macd_value"), [a - b for a, b in zip(values, ema(values, 2))], 1e-7)


def wilder(values, n):
    out, gain, loss = [None] * min(n, len(values)), 0.0, 0.0
    for i in range(1, len(values)):
        change = values[i] - values[i - 1]
        up, down = max(change, 0), max(-change, 0)
        if i <= n:
            gain, loss = gain + up / n, loss + down / n
        else:
            gain, loss = (gain * (n - 1) + up) / n, (loss * (n - 1) + down) / n
        if i >= n:
            out.append(100.0 if loss == 0 else 100 - 100 / (1 + gain / loss))
    return out


@pytest.mark.parametrize("split", [None, Split(rows_per_block=800, piece="month")])
def test_rsi(spark, split):
    values = walk(2000)
    result = indicators.rsi(bars(spark, A=values, B=[1.0] * 20, C=[1.0, 2.0] + [3.0] * 13), split=split).cache()
    close_to(column(result, "rsi_value"), wilder(values, 14), 1e-8)
    assert column(result, "rsi_value", "B") == [None] * 14 + [50.0] * 6
    assert column(result, "rsi_value", "C") == [None] * 14 + [100.0]


@pytest.mark.parametrize("split", [None, Split(rows_per_block=300, piece="year"), Split(rows_per_block=1024, piece="year")])
def test_rsi_of_flat_histories(spark, split):
    """Gain and loss keep their ratio while prices stand still, however long."""
    values = walk(100) + [walk(100)[-1]] * 3900
    result = indicators.rsi(bars(spark, A=values), split=split)
    close_to(column(result, "rsi_value"), wilder(values, 14), 1e-9)


def test_averages_of_tiny_prices(spark):
    df = bars(spark, A=[1e-8, 2e-8, 3e-8], B=[0.125, 0.135, 1e9])
    result = indicators.moving_averages(df, {"m": 3}).cache()
    close_to(column(result, "m"), [1e-8, 1.5e-8, 2e-8], 1e-20)
    assert column(indicators.moving_averages(df, {"m": 2}, digits=2), "m", "B") == [0.13, 0.13, 500000000.07]


def test_averages_of_any_closes(spark):
    """What is no whole number of millionths is added as a double, and is never lost."""
    df = bars(spark, A=[1e-19, 1e-19, 5e18, 1.0, 1.0, math.nan, 1.0, 1.0], B=[math.inf, 1.0, -math.inf, 2.0, 3.0], C=[-1.005, -1.005, 1.0])
    plain = indicators.moving_averages(df, {"m": 2}).cache()
    got = column(plain, "m")
    assert got[:5] == [1e-19, 1e-19, 2.5e18, (5e18 + 1.0) / 2, 1.0] and got[7] == 1.0
    assert math.isnan(got[5]) and math.isnan(got[6])
    assert column(plain, "m", "B")[:2] == [math.inf, math.inf] and column(plain, "m", "B")[2:] == [-math.inf, -math.inf, 2.5]
    both = column(indicators.moving_averages(df, {"m": 3}), "m", "B")
    assert math.isnan(both[2])
    digits = indicators.moving_averages(df, {"m": 2}, digits=2).cache()
    assert column(digits, "m")[:3] == [0.0, 0.0, 2.5e18]
    assert column(digits, "m", "C") == [-1.01, -1.01, 0.0]


def test_totals_of_averages_do_not_overflow(spark):
    large = 2.0**30 - 0.000001
    df = bars(spark, A=[large] * 9_000)
    assert set(column(indicators.moving_averages(df, {"m": 9_000}, digits=2), "m")) == {2.0**30}
    many = bars(spark, A=[5e17] * 30)
    assert column(indicators.moving_averages(many, {"m": 7}), "m") == [5e17] * 30


def steps_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), len([x for x in plan.split("\n") if " Sort [" in x]), plan.count("Window [")


def test_recursive_averages_are_one_pass(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(10).selectExpr("'A' AS ticker", "date_add(date'2024-01-01', int(id)) AS date", "double(id) AS close")
        for whole, split in ((indicators.macd(df), indicators.macd(df, split=BLOCKS)), (indicators.rsi(df), indicators.rsi(df, split=BLOCKS))):
            assert steps_of(whole) == (1, 1, 0)
            shuffles, sorts, windows = steps_of(split)
            assert shuffles <= 4 and sorts <= 4 and windows == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("recursion", [Macd(12, 26, 9), Macd(1, 2, 3), WilderRsi(14), WilderRsi(1)])
def test_pieces_compose_to_the_whole(recursion):
    """However a history is cut, the state before each piece is that of the whole."""
    values, rng = walk(400), random.Random(4)
    for _ in range(20):
        state, at = [], 0
        while at < len(values):
            n = rng.choice([1, 2, 3, 14, 15, 16, 60])
            piece = values[at : at + n]
            expected = recursion.run(values[: at + n], [])[1]
            state = recursion.after(state, recursion.summary(piece))
            close_to(state, expected, 1e-9)
            at += n


def test_recursive_averages_keep_null_tickers_and_dates(spark):
    rows = [(None, START, 1.0), (None, START + dt.timedelta(days=1), 2.0), ("A", None, 3.0), ("A", START, 1.5), ("A", START, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for made in (lambda split: indicators.macd(df, split=split), lambda split: indicators.rsi(df, 1, split=split)):
        whole, pieces = (
            sorted(repr([round(x, 9) if isinstance(x, float) else x for x in row]) for row in made(split).collect())
            for split in (None, BLOCKS)
        )
        assert len(whole) == 4 and pieces == whole
    assert indicators.macd(df.limit(0)).count() == indicators.rsi(df.limit(0), split=BLOCKS).count() == 0


def test_rsi_of_unknown_smoothing(spark):
    with pytest.raises(ValueError):
        indicators.rsi(bars(spark, A=[1.0]), smoothing="none")


def test_split_blocks_stay_small_and_whole(spark):
    """One ticker with most rows: the blocks bound a task's share, and no row is lost."""
    from quotemill.operators.timeline import open_timeline

    hot = bars(spark, A=walk(5000), B=walk(40), C=[1.0])
    line = open_timeline(hot, lookback=100, split=Split(rows_per_block=400, piece="year"))
    sizes = line.rows.groupBy("ticker", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] <= 500
    assert line.close(line.rows).count() == 5041


def test_split_history_carried_on(spark):
    values = walk(900)
    df = bars(spark, A=values, B=walk(10, seed=3))
    cut, last = F.lit(START + dt.timedelta(days=300)), F.lit(START + dt.timedelta(days=700))
    recent, earlier = df.filter(F.col("date") >= cut), df.filter(F.col("date") < cut)
    whole = price_returns(df).filter(F.col("date") >= last)
    part = price_returns(recent, Split(rows_per_block=300), earlier).filter(F.col("date") >= last)
    for name in whole.columns[3:]:
        close_to(column(part, name), column(whole, name))


def test_split_keeps_null_tickers_and_dates(spark):
    rows = [(None, START, 1.0), (None, START + dt.timedelta(days=1), 2.0), ("A", None, 3.0), ("A", START, 1.5)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(repr, daily_price_changes(df).collect()))
    assert sorted(map(repr, daily_price_changes(df, BLOCKS).collect())) == whole


def test_lookback_longer_than_a_block_is_refused(spark):
    with pytest.raises(ValueError):
        price_returns(bars(spark, A=[1.0]), Split(rows_per_block=100))


def test_earlier_bars_complete_the_peak_and_first_close(spark):
    values = walk(900)
    df = bars(spark, A=values, B=walk(10, seed=3))
    cut = F.lit(START + dt.timedelta(days=500))
    recent, earlier = df.filter(F.col("date") >= cut), df.filter(F.col("date") < cut)
    whole = price_returns(df).filter(F.col("date") >= F.lit(START + dt.timedelta(days=800)))
    part = price_returns(recent, earlier=earlier).filter(F.col("date") >= F.lit(START + dt.timedelta(days=800)))
    for name in whole.columns[3:]:
        close_to(column(part, name), column(whole, name))


def test_split_spreads_a_hot_ticker_over_tasks(spark):
    """Most rows in one ticker: every step of a split keeps a task's share small."""
    from quotemill.operators import timeline

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = bars(spark, HOT=walk(16_000), A=walk(500))
        split = Split(rows_per_block=500, piece="month")
        sort = [F.col("date").asc_nulls_last()]
        steps = [
            timeline._global_row_numbers(hot, "ticker", "date", sort, "month"),
            price_returns(hot, split),
            indicators.macd(hot, split=Split(rows_per_block=900)),
        ]
        for step in steps:
            sizes = [r["count"] for r in step.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 16_500 and max(sizes) < 4_000, sizes
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
