"""Ingestion: landed feed files of a day → universe gate → raw table.

Feed files of a run lie in ``<feeds>/<feed>/<run date>/``. Each job reads one feed, keeps the
tickers of that day's index, and replaces a day or a range of days in one raw table. A run that
finds nothing leaves its table as it is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.functions.scalars import days_before
from quotemill.operators.companies import in_universe, universe
from quotemill.sources import feeds
from quotemill.sources.tables import Tables

Day = str | dt.date
Rows = Callable[..., DataFrame]

LOOKUP = "raw/tickers_lookup"


@dataclass(frozen=True)
class Job:
    """``span`` says which days of the table a batch replaces.

    ``"day"``: the run date. ``"lookback"``: the ``lookback_days`` up to the run date.
    ``"batch"``: from the first to the last date in the batch.
    """

    table: str
    feed: str
    schema: object
    rows: Rows
    span: str
    defaults: dict = field(default_factory=dict)
    variants: tuple[str, ...] = ()


def _prices(payloads, run_date, **_):
    return feeds.stock_prices(payloads, run_date)


def _prices_range(payloads, run_date, **_):
    return feeds.stock_prices_range(payloads)


def _indicator(name: str, own_dates: bool = False) -> Rows:
    def rows(payloads, run_date, window, limit):
        return feeds.indicator(
            payloads, run_date, name, window, limit=limit, stamp_run_date=not own_dates
        )

    return rows


def _macd(own_dates: bool = False) -> Rows:
    def rows(payloads, run_date, short_window, long_window, signal_window, limit):
        return feeds.macd(
            payloads,
            run_date,
            short_window,
            long_window,
            signal_window,
            limit=limit,
            stamp_run_date=not own_dates,
        )

    return rows


def _news(payloads, run_date, limit_per_ticker):
    return feeds.news(payloads, run_date, limit_per_ticker)


def _news_range(payloads, run_date, lookback_days, limit_per_ticker):
    return feeds.news_range(payloads, days_before(run_date, lookback_days), run_date, limit_per_ticker)


def _statements(mapping: Callable[[DataFrame], DataFrame]) -> Rows:
    return lambda payloads, run_date: mapping(payloads)


# Default windows, limits and spans of the jobs.
BACKFILL_DAYS = 398
RSI_DEFAULTS = {"window": 14, "limit": 1}
MACD_DEFAULTS = {"short_window": 12, "long_window": 26, "signal_window": 9, "limit": 1}
BACKFILL_POINTS = {"limit": None}  # what has landed is kept; the caller may ask for the newest k
LISTS = ("tickers", "keywords")

JOBS: dict[str, Job] = {
    "prices": Job("raw/stock_prices", "prices", schemas.PRICE_FEED, _prices, "day"),
    "prices_backfill": Job(
        "raw/stock_prices_backfill",
        "prices_range",
        schemas.PRICE_FEED,
        _prices_range,
        "lookback",
        {"lookback_days": BACKFILL_DAYS},
    ),
    "rsi": Job("raw/rsi", "rsi", schemas.INDICATOR_FEED, _indicator("rsi"), "day", RSI_DEFAULTS),
    "rsi_backfill": Job(
        "raw/rsi_backfill",
        "rsi",
        schemas.INDICATOR_FEED,
        _indicator("rsi", own_dates=True),
        "batch",
        RSI_DEFAULTS | BACKFILL_POINTS,
    ),
    "macd": Job("raw/macd", "macd", schemas.MACD_FEED, _macd(), "day", MACD_DEFAULTS),
    "macd_backfill": Job(
        "raw/macd_backfill",
        "macd",
        schemas.MACD_FEED,
        _macd(own_dates=True),
        "batch",
        MACD_DEFAULTS | BACKFILL_POINTS,
    ),
    "sma": Job("raw/sma", "sma", schemas.INDICATOR_FEED, _indicator("sma"), "day", {"window": 30, "limit": None}),
    "news": Job(
        "raw/news", "news", schemas.NEWS_FEED, _news, "day", {"limit_per_ticker": None}, LISTS
    ),
    "news_backfill": Job(
        "raw/news_backfill",
        "news_range",
        schemas.NEWS_FEED,
        _news_range,
        "lookback",
        {"lookback_days": BACKFILL_DAYS, "limit_per_ticker": None},
        LISTS,
    ),
    "income_statements": Job(
        "raw/income_statements",
        "income_statements",
        schemas.statement_feed(schemas.INCOME_AMOUNTS),
        _statements(feeds.income_statements),
        "batch",
    ),
    "balance_sheets": Job(
        "raw/balance_sheets",
        "balance_sheets",
        schemas.statement_feed(schemas.BALANCE_AMOUNTS),
        _statements(feeds.balance_sheets),
        "batch",
    ),
    "cash_flow_statements": Job(
        "raw/cash_flow_statements",
        "cash_flow_statements",
        schemas.statement_feed(schemas.CASH_FLOW_AMOUNTS),
        _statements(feeds.cash_flow_statements),
        "batch",
    ),
}


def raw_schema(table: str):
    return schemas.RAW_TABLES[table.removeprefix("raw/")]


REJECTS = schemas.flat("feed string, reason string, line string, date date")


@dataclass(frozen=True)
class Ingested:
    """What a run did: whether it wrote rows, and how many landed lines it kept apart, by reason."""

    written: bool
    rejects: dict[str, int]

    def __bool__(self) -> bool:
        return self.written


def ingest(tables: Tables, feed_root: str, name: str, run_date: Day, **options) -> Ingested:
    """Run one job. The landed files are read and parsed once: lines that bring rows go to the raw
    table, all others, with the reason, to a table of rejects beside it."""
    job = JOBS[name]
    settings = job.defaults | options
    unknown = set(options) - set(job.defaults)
    if unknown:
        raise ValueError(f"job {name!r} has no option {', '.join(sorted(unknown))}")
    lines = feeds.read_lines(tables.spark, f"{feed_root}/{job.feed}/{run_date}")

    def write(read: DataFrame) -> bool:
        members = universe(tables.read(LOOKUP, schemas.CONSTITUENTS), run_date)
        rows = job.rows(in_universe(feeds.payloads(read), members), run_date=run_date, **settings)
        if job.variants:
            rows = feeds.with_variants(rows, *job.variants)
        rows = feeds.shape(rows, raw_schema(job.table))
        tables.create(job.table, raw_schema(job.table), "date")
        if job.span == "day":
            return tables.replace_day(job.table, rows, run_date)
        if job.span == "lookback":
            start = days_before(run_date, settings["lookback_days"])
            return tables.replace_range(job.table, rows, start, run_date)
        return tables.replace_range(job.table, rows)

    return _with_rejects(tables, feeds.parsed(lines, job.schema), name, run_date, write)


def _with_rejects(tables: Tables, read: DataFrame, name: str, run_date: Day, write: Callable[[DataFrame], bool]) -> Ingested:
    """Write the rows, then the day's rejects, also where there are none, from one reading."""
    read = read.persist()
    try:
        written = write(read)
        table = f"rejects/{name}"
        kept = feeds.rejected(read).select(
            F.lit(name).alias("feed"), "reason", "line", F.lit(str(run_date)).cast("date").alias("date")
        )
        tables.create(table, REJECTS, "date")
        tables.replace_day(table, kept, run_date, if_empty=True)
    finally:
        read.unpersist()
    day = tables.read(table).filter(F.col("date") == F.lit(str(run_date)).cast("date"))
    return Ingested(written, {r["reason"]: r["count"] for r in day.groupBy("reason").count().collect()})


def ingest_constituents(tables: Tables, feed_root: str, run_date: Day) -> Ingested:
    """The day's index members: the universe of all other jobs."""
    path = f"{feed_root}/constituents/{run_date}"

    def write(read: DataFrame) -> bool:
        used = read.filter(F.col("reason").isNull() | (F.col("reason") == "partial"))
        rows = feeds.constituents(used.select(*[f"`{c}`" for c in schemas.CONSTITUENT_FEED.names]), run_date)
        tables.create(LOOKUP, schemas.CONSTITUENTS, "date")
        return tables.replace_day(LOOKUP, rows, run_date)

    return _with_rejects(tables, feeds.read_constituents(tables.spark, path, reasons=True), "constituents", run_date, write)


def ingest_articles(tables: Tables, feed_root: str, run_date: Day) -> Ingested:
    """The day's articles of the global feed, one row per mentioned index member."""
    lines = feeds.read_lines(tables.spark, f"{feed_root}/articles/{run_date}")

    def write(read: DataFrame) -> bool:
        members = universe(tables.read(LOOKUP, schemas.CONSTITUENTS), run_date)
        rows = feeds.shape(feeds.articles(feeds.payloads(read), run_date, members), schemas.ARTICLES)
        tables.create("raw/articles", schemas.ARTICLES, "date")
        return tables.replace_day("raw/articles", rows, run_date)

    return _with_rejects(tables, feeds.parsed(lines, schemas.ARTICLE_FEED), "articles", run_date, write)
