"""Moving averages, RSI and MACD from closing prices, and their join with the provider's feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.operators.recursion import Macd, WilderRsi, along_history
from quotemill.operators.timeline import Split, open_timeline

# Averages kept in the indicator table, and the indicator parameters.
SMA_WINDOWS = {"sma_20": 20, "sma_50": 50, "sma_200": 200}
RSI_WINDOW = 14
MACD_WINDOWS = (12, 26, 9)

# Closes of at most this many parts of one, below a bound where those are told apart, are summed
# as whole numbers, which is exact and order-free.
PARTS, PLAIN_BELOW = 1_000_000, 2.0**30


def moving_averages(
    prices: DataFrame,
    windows: dict[str, int] | None = None,
    digits: int | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Simple moving averages over the last n rows; a shorter history averages what there is.

    Closes with up to six decimal places, below 2**30, are exact: the sum of a window is the
    difference of two running totals in whole numbers (of units and of millionths, so no total
    overflows), whatever the order of evaluation, and the result alone is rounded, half away from
    zero. All other closes are added as doubles over the rows of each window, in their order, so
    none of them disappears in a total: an average over 1e-19 is 1e-19 and one over 5e18 is 5e18; a
    window that holds NaN averages to NaN, one that holds infinity to infinity, both infinities to
    NaN. NULL closes are left out.
    """
    windows = windows or SMA_WINDOWS
    line = open_timeline(
        prices.select("ticker", "date", "close"), lookback=max(windows.values()), split=split
    )
    close = F.col("close").cast("double")
    units = F.rint(close * PARTS)
    plain = (F.abs(close) < PLAIN_BELOW) & (units / PARTS == close)
    rows = line.rows.withColumn("_units", F.when(plain, units.cast("long")))
    rows = rows.withColumn("_other", F.when(F.col("_units").isNull(), close))
    running = {
        "_whole": F.sum(F.call_function("div", F.col("_units"), F.lit(PARTS))),
        "_millionths": F.sum(F.col("_units") % PARTS),
        "_plain": F.count("_units"),
        "_others": F.count("_other"),
    }
    totals = rows.withColumns(
        {name: F.coalesce(total.over(line.history), F.lit(0).cast("long")) for name, total in running.items()}
    )
    sums = {}
    for name, n in windows.items():
        for c in running:
            sums[f"{c}_{name}"] = F.col(c) - F.coalesce(line.lag(c, n), F.lit(0).cast("long"))
        sums[f"_other_{name}"] = F.sum("_other").over(line.frame(n))
    held = totals.withColumns(sums)
    # In steps, so that a value that is used twice is computed once.
    for step in (_signs, _carries, _rests, _means):
        made = [step(name, digits) for name in windows]
        held = held.withColumns({c: value for columns in made for c, value in columns.items()})
    return line.close(held.select(*line.rows.columns, *windows))


def _signs(name: str, digits: int | None) -> dict[str, Column]:
    """The plain total in millionths, as a double whose sign is exact."""
    plain = F.col(f"_whole_{name}").cast("double") * PARTS + F.col(f"_millionths_{name}").cast("double")
    return {f"_total_{name}": plain, f"_sign_{name}": F.when(plain < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")}


def _carries(name: str, digits: int | None) -> dict[str, Column]:
    """The total without its sign, in units and millionths that are not negative."""
    part = F.col(f"_millionths_{name}") * F.col(f"_sign_{name}")
    borrowed = F.when(part < 0, F.ceil(-part / PARTS)).otherwise(F.lit(0)).cast("long")
    return {
        f"_size_{name}": F.col(f"_whole_{name}") * F.col(f"_sign_{name}") - borrowed,
        f"_less_{name}": part + borrowed * PARTS,
        f"_rows_{name}": F.nullif(f"_plain_{name}", F.lit(0)),
    }


def _rests(name: str, digits: int | None) -> dict[str, Column]:
    size, less, rows = (F.col(f"{c}_{name}") for c in ("_size", "_less", "_rows"))
    return {f"_rest_{name}": (size % rows) * PARTS + less, f"_units_{name}": F.call_function("div", size, rows)}


def _means(name: str, digits: int | None) -> dict[str, Column]:
    """The mean; rounding is half away from zero, in whole numbers unless doubles were added."""
    total, others, other, rows = (F.col(f"{c}_{name}") for c in ("_total", "_others", "_other", "_rows"))
    every = (F.col(f"_plain_{name}") + others).cast("double")
    mixed = F.try_divide(total / F.lit(float(PARTS)) + other, every)
    if digits is None:
        exact = total / (rows.cast("double") * PARTS)
    else:
        steps = 10**digits
        twice = F.col(f"_rest_{name}") * (2 * steps) + rows * PARTS
        fraction = F.call_function("div", twice, rows * (2 * PARTS))
        exact = F.col(f"_sign_{name}") * (F.col(f"_units_{name}") * steps + fraction) / F.lit(float(steps))
        mixed = F.round(mixed, digits)
    return {name: F.when(others == 0, exact).otherwise(mixed)}


def technical_indicators(
    prices: DataFrame, rsi: DataFrame, macd: DataFrame, split: Split | None = None
) -> DataFrame:
    """Moving averages of the bars joined with the RSI and MACD points of the same day."""
    averages = moving_averages(prices, digits=2, split=split)
    rsi_points = rsi.select(
        "ticker",
        "date",
        F.round("rsi_value", 2).alias("rsi_value"),
        F.col("window_size").alias("rsi_window_size"),
        F.col("timespan").alias("rsi_timespan"),
        F.col("series_type").alias("rsi_series_type"),
    )
    macd_points = macd.select(
        "ticker",
        "date",
        F.round("macd_value", 4).alias("macd_value"),
        F.round("signal_value", 4).alias("macd_signal"),
        F.round("histogram_value", 4).alias("macd_histogram"),
    )
    return averages.join(rsi_points, ["ticker", "date"], "left").join(
        macd_points, ["ticker", "date"], "left"
    )


def macd(
    prices: DataFrame,
    short_window: int = MACD_WINDOWS[0],
    long_window: int = MACD_WINDOWS[1],
    signal_window: int = MACD_WINDOWS[2],
    split: Split | None = None,
) -> DataFrame:
    """MACD line, signal line and histogram of the closes; rows without a close are left out."""
    return along_history(_closes(prices), Macd(short_window, long_window, signal_window), split)


def rsi(
    prices: DataFrame,
    window: int = RSI_WINDOW,
    smoothing: str = "wilder",
    split: Split | None = None,
) -> DataFrame:
    """Relative strength index of the closes, NULL until ``window`` changes are known.

    ``smoothing="wilder"`` starts from the mean of the first changes and smooths from there;
    ``"simple"`` takes the mean over the last ``window`` changes.
    """
    if smoothing == "wilder":
        return along_history(_closes(prices), WilderRsi(window), split)
    if smoothing != "simple":
        raise ValueError(f"unknown smoothing: {smoothing}")
    line = open_timeline(_closes(prices), lookback=window + 1, split=split)
    change = F.col("close") - line.lag("close")
    df = line.rows.withColumns({"_n": line.place(), "_change": change})
    recent = line.frame(window)
    df = df.withColumn("_gain", F.avg(F.greatest(F.col("_change"), F.lit(0.0))).over(recent))
    df = df.withColumn("_loss", F.avg(F.greatest(-F.col("_change"), F.lit(0.0))).over(recent))
    strength = F.try_divide(F.col("_gain"), F.col("_loss"))
    value = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + strength))
    value = F.when((F.col("_loss") == 0) & (F.col("_gain") == 0), F.lit(50.0)).otherwise(value)
    df = df.withColumn("rsi_value", F.when(F.col("_n") > window, value))
    return line.close(df).select("ticker", "date", "rsi_value")


def _closes(prices: DataFrame) -> DataFrame:
    closes = prices.select("ticker", "date", F.col("close").cast("double").alias("close"))
    return closes.filter(F.col("close").isNotNull())
