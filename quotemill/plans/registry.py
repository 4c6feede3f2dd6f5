"""Every operator as a named query over a folder of driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill import schemas
from quotemill.functions.scalars import before_end_of_day, days_before
from quotemill.operators import (
    companies,
    composite,
    fundamentals,
    indicators,
    merge,
    quality,
    returns,
    scoring,
    state,
)
from quotemill.operators.semantic import COARSER, MODELS, from_rollup, query, rollup
from quotemill.operators.timeline import Split
from quotemill.operators.topk import latest_k
from quotemill.plans import build, incremental, latest, screens
from quotemill.plans.ingest import JOBS, ingest, ingest_constituents
from quotemill.plans.marts import Marts, create_views
from quotemill.session import scratch_folder, tune
from quotemill.sources import adapters, feeds
from quotemill.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2000-06-30"
LAST_DATE = "9999-12-31"
CUTOFF = dt.date(2001, 6, 30)
SMALL_BLOCKS = Split(rows_per_block=512, piece="month")

REGISTRY: dict[str, Query] = {}


def registered(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(tune(spark), folder)

    REGISTRY[function.__name__] = run
    return function


class Raw(dict):
    """Raw tables by name, derived from the driver tables when first asked for."""

    BUILDERS = {
        "stock_prices": adapters.stock_prices,
        "rsi": adapters.rsi_points,
        "macd": adapters.macd_points,
        "income_statements": adapters.income_statements,
        "balance_sheets": adapters.balance_sheets,
        "cash_flow_statements": adapters.cash_flow_statements,
        "tickers_lookup": adapters.tickers_lookup,
    }

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __contains__(self, name: object) -> bool:
        return name in self.BUILDERS

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.BUILDERS[name](self.spark, self.folder)
        return self[name]


def marts(spark: SparkSession, folder: str) -> Marts:
    return Marts(Raw(spark, folder))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round results of floating-point sums, whose last digits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def cast(df: DataFrame, kind: str, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c in columns})


# ---------------------------------------------------------------------------
# Prices
# ---------------------------------------------------------------------------


@registered
def staged_prices(spark, folder):
    return marts(spark, folder)._stage("stock_prices")


@registered
def daily_price_changes(spark, folder):
    return rounded(marts(spark, folder).daily_price_changes, 2, "price_change")


@registered
def price_returns(spark, folder):
    return rounded(marts(spark, folder).price_returns, 6, "rolling_30d_volatility")


@registered
def price_returns_split(spark, folder):
    rows = returns.price_returns(adapters.stock_prices(spark, folder), split=SMALL_BLOCKS)
    return rounded(rows, 6, "rolling_30d_volatility")


@registered
def rolling_volatility(spark, folder):
    rows = marts(spark, folder).price_returns.select("ticker", "date", "rolling_30d_volatility")
    return rounded(rows, 6, "rolling_30d_volatility")


@registered
def running_drawdown(spark, folder):
    return marts(spark, folder).price_returns.select("ticker", "date", "running_max_price", "drawdown_pct")


@registered
def sma_indicators(spark, folder):
    windows = {**indicators.SMA_WINDOWS, "sma_30": 30}
    return indicators.moving_averages(adapters.stock_prices(spark, folder), windows, digits=2)


@registered
def sma_split(spark, folder):
    prices = adapters.stock_prices(spark, folder)
    return indicators.moving_averages(prices, digits=2, split=SMALL_BLOCKS)


@registered
def rsi(spark, folder):
    return rounded(indicators.rsi(adapters.stock_prices(spark, folder)), 9, "rsi_value")


@registered
def rsi_simple(spark, folder):
    values = indicators.rsi(adapters.stock_prices(spark, folder), smoothing="simple")
    return rounded(values, 9, "rsi_value")


@registered
def macd(spark, folder):
    values = indicators.macd(adapters.stock_prices(spark, folder))
    return rounded(values, 6, "macd_value", "signal_value", "histogram_value")


YEAR_BLOCKS = Split(rows_per_block=128, piece="year")


@registered
def rsi_split(spark, folder):
    return rounded(indicators.rsi(adapters.stock_prices(spark, folder), split=YEAR_BLOCKS), 9, "rsi_value")


@registered
def macd_split(spark, folder):
    values = indicators.macd(adapters.stock_prices(spark, folder), split=YEAR_BLOCKS)
    return rounded(values, 6, "macd_value", "signal_value", "histogram_value")


@registered
def technical_indicators_join(spark, folder):
    return marts(spark, folder).technical_indicators


@registered
def technical_scores(spark, folder):
    return marts(spark, folder).technical_scores


# ---------------------------------------------------------------------------
# Statements
# ---------------------------------------------------------------------------

STATEMENT_AMOUNTS = [
    c
    for c in fundamentals.INCOME_COLUMNS + fundamentals.BALANCE_COLUMNS + fundamentals.CASH_FLOW_COLUMNS
    if c not in ("date", "ticker", "fiscal_year", "period", "eps_diluted")
]


def _statements(spark, folder):
    return fundamentals.join_statements(
        adapters.income_statements(spark, folder),
        adapters.balance_sheets(spark, folder),
        adapters.cash_flow_statements(spark, folder),
    )


@registered
def fundamentals_join(spark, folder):
    return cast(_statements(spark, folder), "bigint", *STATEMENT_AMOUNTS)


@registered
def ratios(spark, folder):
    rows = fundamentals.add_ratios(_statements(spark, folder))
    return cast(rows.select("ticker", "date", *fundamentals.RATIOS), "double", *fundamentals.RATIOS)


@registered
def yoy_growth(spark, folder):
    rows = fundamentals.add_growth(_statements(spark, folder))
    return cast(rows.select("ticker", "date", *fundamentals.GROWTH), "double", *fundamentals.GROWTH)


SCORE_RATIOS = """
    gross_margin operating_margin net_margin return_on_equity current_ratio debt_to_equity
    fcf_margin revenue_growth_yoy eps_growth_yoy fcf_growth_yoy
""".split()


@registered
def fundamental_scores(spark, folder):
    return cast(marts(spark, folder).fundamental_scores, "double", *SCORE_RATIOS)


# ---------------------------------------------------------------------------
# Companies and composite scores
# ---------------------------------------------------------------------------


@registered
def companies_snapshot(spark, folder):
    return marts(spark, folder).companies_snapshot.drop("extracted_at")


@registered
def companies_current(spark, folder):
    return marts(spark, folder).companies_current.drop("extracted_at")


@registered
def universe_distinct(spark, folder):
    return companies.universe(adapters.tickers_lookup(spark, folder), adapters.SNAPSHOT_DATES[1])


@registered
def universe_semi_join(spark, folder):
    members = companies.universe(adapters.tickers_lookup(spark, folder), adapters.SNAPSHOT_DATES[1])
    bars = adapters.stock_prices(spark, folder).select("ticker", "date", "close", "volume")
    return companies.in_universe(bars, members)


@registered
def fiscal_periods(spark, folder):
    return composite.fiscal_periods(marts(spark, folder).fundamental_scores)


def _composite(spark, folder, matching):
    built = marts(spark, folder)
    scores = composite.composite_scores(built.technical_scores, built.fundamental_scores, matching)
    return cast(scores, "double", *composite.WEIGHTS)


@registered
def composite_scores(spark, folder):
    return _composite(spark, folder, "inclusive")


@registered
def composite_half_open(spark, folder):
    return _composite(spark, folder, "half_open")


@registered
def composite_asof(spark, folder):
    return _composite(spark, folder, "asof")


@registered
def industry_scores(spark, folder):
    return cast(marts(spark, folder).industry_scores, "double", *composite.WEIGHTS)


@registered
def price_performance(spark, folder):
    return rounded(marts(spark, folder).price_performance, 6, "rolling_30d_volatility")


# ---------------------------------------------------------------------------
# Newest rows, news, JSON
# ---------------------------------------------------------------------------


@registered
def latest_k_points(spark, folder):
    """The five newest event values per user up to the end of a day."""
    points = adapters.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        "event_id",
        "value",
    )
    known = points.filter(before_end_of_day(F.col("timestamp"), "2024-01-20"))
    order = [F.col("timestamp").desc(), F.col("event_id").desc()]
    return latest_k(known, 5, newest=order, spread=["event_id"])


def _news_payloads(spark, folder):
    """Documents as news payloads: pages of ten articles per ticker."""
    doc = F.col("doc_id")
    day = F.when(F.col("lang") == "en", F.lit(adapters.NEWS_DATES[0])).otherwise(F.lit(adapters.NEWS_DATES[1]))
    hour, minute = F.lpad((doc % 24).cast("string"), 2, "0"), F.lpad((doc % 60).cast("string"), 2, "0")
    ticker = (doc % 10).cast("string")
    article = F.struct(
        F.concat(F.lit("doc/"), doc.cast("string")).alias("id"),
        F.struct(
            F.col("source").alias("name"), F.concat(F.lit("http://"), "source").alias("homepage_url")
        ).alias("publisher"),
        F.concat(F.lit("Document "), doc.cast("string")).alias("title"),
        F.concat(day, F.lit("T"), hour, F.lit(":"), minute, F.lit(":00Z")).alias("published_utc"),
        F.array(ticker).alias("tickers"),
        F.col("text").alias("description"),
        F.array("lang", "source").alias("keywords"),
    )
    pages = (
        adapters.table(spark, folder, "documents")
        .groupBy(ticker.alias("ticker"), F.floor(doc / 100).alias("page"))
        .agg(F.collect_list(article).alias("results"))
        .select("ticker", F.lit("OK").alias("status"), "results")
    )
    return _through_json(pages, schemas.NEWS_FEED)


NEWS_COLUMNS = """
    ticker article_id publisher_name publisher_homepage_url title published_utc tickers
    description keywords date
""".split()


def _landed(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/quotemill-feeds/{uuid.uuid4().hex}"


def _through_json(payloads: DataFrame, schema) -> DataFrame:
    """Payloads as they read back from a landed file of JSON lines."""
    path = _landed(payloads.sparkSession)
    payloads.select(F.to_json(F.struct(*payloads.columns)).alias("line")).write.text(path)
    return feeds.read_feed(payloads.sparkSession, path, schema)


@registered
def feed_news(spark, folder):
    rows = feeds.news(_news_payloads(spark, folder), adapters.NEWS_DATES[0], limit_per_ticker=10)
    return rows.select(*NEWS_COLUMNS)


@registered
def feed_news_range(spark, folder):
    rows = feeds.news_range(_news_payloads(spark, folder), *adapters.NEWS_DATES)
    return rows.select(*NEWS_COLUMNS)


@registered
def latest_k_articles(spark, folder):
    """The ten newest articles per ticker over all days, keywords read out of a variant."""
    rows = feeds.news_range(_news_payloads(spark, folder), *adapters.NEWS_DATES, limit_per_ticker=10)
    rows = feeds.with_variants(rows, "keywords")
    language = F.try_variant_get("keywords", "$[0]", "string")
    return rows.select("ticker", "article_id", "published_utc", language.alias("lang"))


@registered
def news_ticker_explode(spark, folder):
    members = companies.universe(adapters.tickers_lookup(spark, folder), adapters.SNAPSHOT_DATES[1])
    rows = feeds.articles(adapters.article_feed(spark, folder), adapters.NEWS_DATES[0], members)
    return rows.select("ticker", "title", "date", "content", "article_tickers", "article_url", "site")


@registered
def json_variant(spark, folder):
    events = adapters.table(spark, folder, "events").select("event_id", "props")
    parsed = feeds.with_variants(events, "props")
    return parsed.select("event_id", F.variant_get("props", "$.k", "int").alias("k"))


# ---------------------------------------------------------------------------
# Feeds, read back from JSON text
# ---------------------------------------------------------------------------


def _millis(date):
    return F.unix_date(date).cast("bigint") * 86_400_000


def _monthly_pages(rows: DataFrame, item, *, nested: bool = False) -> DataFrame:
    """Payloads of one ticker and month each, so none grows beyond a month of days."""
    pages = rows.groupBy("ticker", F.trunc("date", "month").alias("month")).agg(
        F.collect_list(item).alias("items")
    )
    results = F.struct(F.col("items").alias("values")) if nested else F.col("items")
    return pages.select("ticker", F.lit("OK").alias("status"), results.alias("results"))


def _price_payloads(spark, folder):
    bar = F.struct(
        F.col("open").alias("o"),
        F.col("high").alias("h"),
        F.col("low").alias("l"),
        F.col("close").alias("c"),
        F.col("volume").cast("double").alias("v"),
        F.col("vwap").alias("vw"),
        F.col("transactions").alias("n"),
        _millis("date").alias("t"),
    )
    return _through_json(_monthly_pages(adapters.stock_prices(spark, folder), bar), schemas.PRICE_FEED)


@registered
def feed_prices(spark, folder):
    return feeds.stock_prices(_price_payloads(spark, folder), RUN_DATE).drop("extracted_at")


@registered
def feed_prices_range(spark, folder):
    return feeds.stock_prices_range(_price_payloads(spark, folder)).drop("extracted_at")


@registered
def feed_indicator(spark, folder):
    point = F.struct(_millis("date").alias("timestamp"), F.col("rsi_value").alias("value"))
    pages = _monthly_pages(adapters.rsi_points(spark, folder), point, nested=True)
    payloads = _through_json(pages, schemas.INDICATOR_FEED)
    return feeds.indicator(payloads, RUN_DATE, "rsi", 14, limit=120).drop("extracted_at")


@registered
def feed_indicator_range(spark, folder):
    """The backfill form: rows dated by their own time."""
    point = F.struct(_millis("date").alias("timestamp"), F.col("close").alias("value"))
    pages = _monthly_pages(adapters.stock_prices(spark, folder), point, nested=True)
    payloads = _through_json(pages, schemas.INDICATOR_FEED)
    rows = feeds.indicator(payloads, LAST_DATE, "sma", 30, stamp_run_date=False)
    return rows.drop("extracted_at")


@registered
def feed_macd(spark, folder):
    point = F.struct(
        _millis("date").alias("timestamp"),
        F.col("macd_value").alias("value"),
        F.col("signal_value").alias("signal"),
        F.col("histogram_value").alias("histogram"),
    )
    pages = _monthly_pages(adapters.macd_points(spark, folder), point, nested=True)
    payloads = _through_json(pages, schemas.MACD_FEED)
    return feeds.macd(payloads, RUN_DATE, limit=1).drop("extracted_at")


def _statement_payloads(rows: DataFrame, amounts: list[str]) -> DataFrame:
    """One payload per ticker and decade of annual statements."""
    fields = [c for c in rows.columns if c != "ticker"]
    accepted = F.concat(F.col("date").cast("string"), F.lit(" 16:30:00")).alias("acceptedDate")
    record = F.struct(accepted, *[F.col(c).alias(schemas.feed_name(c)) for c in fields])
    decade = F.floor(F.year("date") / 10).alias("decade")
    pages = rows.groupBy("ticker", decade).agg(F.collect_list(record).alias("results"))
    return _through_json(pages.select("ticker", "results"), schemas.statement_feed(amounts))


@registered
def feed_income(spark, folder):
    payloads = _statement_payloads(adapters.income_statements(spark, folder), schemas.INCOME_AMOUNTS)
    columns = ["revenue", "gross_profit", "operating_income", "net_income", "weighted_average_shares_out_diluted"]
    rows = feeds.income_statements(payloads).select(
        "ticker", "date", "accepted_date", "fiscal_year", "period", *columns, "eps_diluted"
    )
    return cast(rows, "bigint", *columns)


@registered
def feed_balance(spark, folder):
    payloads = _statement_payloads(adapters.balance_sheets(spark, folder), schemas.BALANCE_AMOUNTS)
    columns = fundamentals.BALANCE_COLUMNS
    rows = feeds.balance_sheets(payloads).select("ticker", "date", "fiscal_year", "period", *columns)
    return cast(rows, "bigint", *columns)


@registered
def feed_cash_flow(spark, folder):
    payloads = _statement_payloads(adapters.cash_flow_statements(spark, folder), schemas.CASH_FLOW_AMOUNTS)
    columns = fundamentals.CASH_FLOW_COLUMNS
    rows = feeds.cash_flow_statements(payloads).select("ticker", "date", "fiscal_year", "period", *columns)
    return cast(rows, "bigint", *columns)


@registered
def feed_constituents(spark, folder):
    path = _landed(spark)
    adapters.constituents(spark, folder).drop("s_acctbal").write.option("header", True).csv(path)
    return feeds.constituents(feeds.read_constituents(spark, path), RUN_DATE).drop("extracted_at")


@registered
def feed_rejects(spark, folder):
    """Landed lines that bring no rows, by reason: one kind of damage per remainder of the supplier key."""
    supplier = F.col("s_suppkey")
    item = F.struct(F.lit(1.0).alias("c"), F.lit(0).cast("bigint").alias("t"))
    payload = F.struct(
        supplier.cast("string").alias("ticker"),
        F.when(supplier % 7 == 0, "ERROR").otherwise("OK").alias("status"),
        F.when(supplier % 7 == 1, F.array().cast("array<struct<c:double,t:bigint>>")).otherwise(F.array(item)).alias("results"),
    )
    line = F.to_json(payload)
    line = F.when(supplier % 7 == 2, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    path = _landed(spark)
    adapters.table(spark, folder, "supplier").select(line.alias("line")).write.text(path)
    lines = feeds.read_rejects(spark, path, schemas.PRICE_FEED)
    return lines.groupBy("reason").agg(F.count("*").alias("lines"))


@registered
def ingest_rejects(spark, folder):
    """A price, an indicator and a statement feed through their jobs, a payload a supplier, two in
    seven of them damaged: rows stored, and lines kept apart by reason."""
    tables, root = _warehouse(spark), _landed(spark)
    members = adapters.constituents(spark, folder).drop("s_acctbal")
    members.write.option("header", True).csv(f"{root}/constituents/{RUN_DATE}")
    ingest_constituents(tables, root, RUN_DATE)
    supplier, close = F.col("s_suppkey"), F.col("s_acctbal").cast("double")
    day = F.date_sub(F.lit(RUN_DATE).cast("date"), (supplier % 5).cast("int"))
    value = F.struct(_millis(day).alias("timestamp"), close.alias("value"))
    results = {
        "prices_backfill": F.array(F.struct(close.alias("c"), _millis(day).alias("t"))),
        "rsi_backfill": F.struct(F.array(value).alias("values")),
        "income_statements": F.array(F.struct(day.cast("string").alias("date"), F.lit("FY").alias("period"))),
    }
    found = []
    for job, result in results.items():
        payload = F.struct(supplier.cast("string").alias("ticker"), F.lit("OK").alias("status"), result.alias("results"))
        line = F.to_json(payload)
        line = F.when(supplier % 7 == 0, F.left(line, F.length(line) - 2)).when(supplier % 7 == 1, F.lit("{}")).otherwise(line)
        landed = adapters.table(spark, folder, "supplier").select(line.alias("line"))
        landed.write.text(f"{root}/{JOBS[job].feed}/{RUN_DATE}")
        ingest(tables, root, job, RUN_DATE)
        stored = tables.read(JOBS[job].table).select(F.lit(job).alias("job"), F.lit("stored").alias("reason"))
        found += [stored, tables.read(f"rejects/{job}").select(F.col("feed").alias("job"), "reason")]
    return reduce(DataFrame.unionByName, found).groupBy("job", "reason").agg(F.count("*").alias("lines"))


@registered
def feed_reference(spark, folder):
    listing = F.struct(
        F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_name").alias("name"), F.lit(True).alias("active")
    )
    pages = (
        adapters.table(spark, folder, "supplier")
        .groupBy(F.floor(F.col("s_suppkey") / 100).alias("page"))
        .agg(F.collect_list(listing).alias("results"))
        .select(F.lit("OK").alias("status"), "results")
    )
    payloads = _through_json(pages, schemas.REFERENCE_FEED)
    return feeds.reference_tickers(payloads).select("ticker", "name", "active")


# ---------------------------------------------------------------------------
# Table maintenance
# ---------------------------------------------------------------------------


def _versioned(bars: DataFrame, version: int) -> DataFrame:
    return bars.select("ticker", "date", "close", F.lit(version).alias("version"))


@registered
def delete_insert_merge(spark, folder):
    """Bars up to 2000 merged with a newer batch that overlaps their last month."""
    bars = adapters.stock_prices(spark, folder)
    target = _versioned(bars.filter(F.col("date") <= F.lit("2000-12-31").cast("date")), 1)
    batch = _versioned(bars.filter(F.col("date") >= F.lit("2000-12-01").cast("date")), 2)
    return merge.delete_insert(target, batch, ["ticker", "date"])


def _busy(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("volume") >= 40)


@registered
def overwrite_date_range(spark, folder):
    """A range of days replaced by the busy bars in it; days without any end up empty."""
    bars = adapters.stock_prices(spark, folder)
    start, end = "2000-01-01", "2000-06-30"
    batch = _versioned(_busy(bars).filter(merge.in_range("date", start, end)), 2)
    return merge.replace_range(_versioned(bars, 1), batch, start, end)


@registered
def overwrite_partition(spark, folder):
    bars = adapters.stock_prices(spark, folder)
    day = "2000-06-15"
    batch = _versioned(_busy(bars).filter(merge.in_range("date", day, day)), 2)
    return merge.replace_day(_versioned(bars, 1), batch, day)


# -- tables that are written and read back -----------------------------------

MONTH = "2000-06-01"
MONTHS = ("2000-01-01", "2000-06-01")


def _warehouse(spark: SparkSession) -> Tables:
    return Tables(spark, f"{scratch_folder(spark)}/quotemill-tables/{uuid.uuid4().hex}")


def _monthly(spark, folder, version: int) -> DataFrame:
    """Shares traded per ticker and month, dated by the month's first day."""
    lines = adapters.stock_prices(spark, folder)
    monthly = lines.groupBy("ticker", F.trunc("date", "month").alias("date"))
    return monthly.agg(F.sum("volume").alias("volume")).withColumn("version", F.lit(version))


def _with_monthly_table(spark, folder) -> Tables:
    tables = _warehouse(spark)
    tables.create("raw/volumes", T.StructType.fromDDL("ticker string, volume bigint, version int, date date"), "date")
    tables.replace_range("raw/volumes", _monthly(spark, folder, 1))
    return tables


@registered
def table_replace_day(spark, folder):
    tables = _with_monthly_table(spark, folder)
    batch = _monthly(spark, folder, 2).filter((F.col("volume") >= 60) & merge.in_range("date", MONTH, MONTH))
    tables.replace_day("raw/volumes", batch, MONTH)
    return tables.read("raw/volumes")


@registered
def table_replace_range(spark, folder):
    """Only the last month of the range has rows in the batch: the others end up empty."""
    tables = _with_monthly_table(spark, folder)
    batch = _monthly(spark, folder, 2).filter(merge.in_range("date", MONTHS[1], MONTHS[1]))
    tables.replace_range("raw/volumes", batch, *MONTHS)
    return tables.read("raw/volumes")


@registered
def table_delete_insert(spark, folder):
    tables = _with_monthly_table(spark, folder)
    batch = _monthly(spark, folder, 2).filter(F.col("volume") >= 60)
    tables.delete_insert("raw/volumes", batch, ["ticker", "date"], "date")
    return tables.read("raw/volumes")


@registered
def table_full_refresh(spark, folder):
    """A table replaced by one derived from it."""
    tables = _warehouse(spark)
    tables.overwrite("marts/volumes", _monthly(spark, folder, 1))
    again = tables.read("marts/volumes").withColumn("version", F.col("version") + 1)
    tables.overwrite("marts/volumes", again)
    return tables.read("marts/volumes")


@registered
def table_range_atomic(spark, folder):
    """A range replaced by a batch: what readers see while its files are there already but not yet
    published, and what they see after."""
    tables = _with_monthly_table(spark, folder)
    batch = _monthly(spark, folder, 2).filter(merge.in_range("date", MONTHS[1], MONTHS[1]))
    tables.prepare("raw/volumes", batch, "date")
    before = tables.read("raw/volumes").withColumn("seen", F.lit("before"))
    tables.replace_range("raw/volumes", batch, *MONTHS)
    return before.unionByName(tables.read("raw/volumes").withColumn("seen", F.lit("after")))


@registered
def table_as_of(spark, folder):
    """An older version of a table, and whether the newest one has other rows on that day."""
    tables = _with_monthly_table(spark, folder)
    then = tables.manifest("raw/volumes")
    tables.replace_range("raw/volumes", _monthly(spark, folder, 2).filter(merge.in_range("date", MONTH, MONTH)), *MONTHS)
    changed = [dt.date.fromisoformat(day) for day in tables.changed_days("raw/volumes", then.version)]
    old = tables.read("raw/volumes", as_of=then.seconds)
    return old.withColumn("changed", F.col("date").isin(changed))


@registered
def checked_write(spark, folder):
    """What was measured while a table was written, and whether a batch that breaks a rule got in."""
    tables = _with_monthly_table(spark, folder)
    small = quality.Rule("at least 60 shares", F.col("volume") < 60)
    try:
        tables.replace_range("raw/volumes", _monthly(spark, folder, 2), rules=[small])
        refused = False
    except quality.QualityError:
        refused = True
    commits = tables.manifest("raw/volumes").commits.values()
    rows, nulls = (sum(c.metrics[key] for c in commits) for key in ("rows", "nulls.ticker"))
    versions = tables.read("raw/volumes").agg(F.max("version").alias("version"))
    return versions.select(
        F.lit(rows).cast("long").alias("rows"), F.lit(nulls).cast("long").alias("nulls"), F.lit(refused).alias("refused"), "version"
    )


@registered
def job_news_backfill(spark, folder):
    """News of a lookback through their job: a range of days replaced, text lists kept as variants."""
    tables, root, run_date = _warehouse(spark), _landed(spark), adapters.NEWS_DATES[1]
    members = adapters.constituents(spark, folder).drop("s_acctbal")
    members.write.option("header", True).csv(f"{root}/constituents/{run_date}")
    ingest_constituents(tables, root, run_date)
    payloads = _news_payloads(spark, folder)
    line = F.to_json(F.struct(*payloads.columns)).alias("line")
    payloads.select(line).write.text(f"{root}/{JOBS['news_backfill'].feed}/{run_date}")
    ingest(tables, root, "news_backfill", run_date, lookback_days=1)
    language = F.try_variant_get("keywords", "$[0]", "string")
    return tables.read("raw/news_backfill").select("ticker", "article_id", "date", language.alias("lang"))


@registered
def staged_views(spark, folder):
    """A staging view asked in SQL."""
    create_views(Raw(spark, folder), ["stock_prices"])
    return spark.sql("SELECT ticker, date, close, volume FROM stg_stock_prices WHERE volume >= 60")


@registered
def exposed_marts(spark, folder):
    """Marts open to semantic queries that load, with their rows; those that do not have none."""
    tables, built, warnings = _warehouse(spark), marts(spark, folder), []
    for name in ("technical_scores", "fundamental_scores"):
        tables.overwrite(build.MODELS[name].path, getattr(built, name))
    loaded = build.exposed(tables, warnings.append)
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in loaded.items()]
    skipped = [counts[0].select(F.lit(w.split()[3].rstrip(":")).alias("name"), F.lit(None).cast("long").alias("rows")) for w in warnings]
    return reduce(DataFrame.unionByName, counts + skipped)


@registered
def table_variants(spark, folder):
    tables = _warehouse(spark)
    events = adapters.table(spark, folder, "events").select("event_id", "props")
    tables.overwrite("raw/events", feeds.with_variants(events, "props"))
    stored = tables.read("raw/events")
    return stored.select("event_id", F.variant_get("props", "$.k", "int").alias("k"))


# -- incremental runs: from the last day of the target on --------------------


def _carried_on(tables: Tables, target: DataFrame, date: str, days: int, batch_since, keys=("ticker", "date")) -> DataFrame:
    """``target``, stored, after an incremental run that starts ``days`` before the last day it holds."""
    tables.overwrite("marts/target", target)
    last = tables.last_date("marts/target", date)
    if last is not None:
        tables.delete_insert("marts/target", batch_since(days_before(last, days)), list(keys), None)
    return tables.read("marts/target")


def _stored(tables: Tables, name: str, rows: DataFrame) -> DataFrame:
    tables.overwrite(name, rows)
    return tables.read(name)


def _known(df: DataFrame, date: str = "date") -> DataFrame:
    """What a table held on the day of the cutoff."""
    return df.filter(F.col(date) <= F.lit(CUTOFF))


def _bars(spark, folder) -> DataFrame:
    return adapters.stock_prices(spark, folder).select("ticker", "date", "close")


def _closed(tables: Tables, bars: DataFrame, since: dt.date, model: str) -> DataFrame:
    """The stored state of the bars before those that an incremental run reads."""
    start = incremental.near_start(since, model)
    return _stored(tables, "state/stock_prices", state.history_state(bars.filter(F.col("date") < F.lit(start))))


@registered
def incremental_daily_changes(spark, folder):
    tables = _warehouse(spark)
    bars = _stored(tables, "raw/stock_prices", _bars(spark, folder))
    target = returns.daily_price_changes(_known(bars))

    def new(since):
        return incremental.new_price_changes(bars, since, closed=_closed(tables, bars, since, "daily_price_changes"))

    return rounded(_carried_on(tables, target, "date", incremental.WRITE_DAYS, new), 2, "price_change")


@registered
def incremental_price_returns(spark, folder):
    """Returns built up to a day, then carried on to the last one by an incremental run, which reads
    recent bars and the stored state of the older ones."""
    tables = _warehouse(spark)
    bars = _stored(tables, "raw/stock_prices", _bars(spark, folder))
    target = returns.price_returns(_known(bars))

    def new(since):
        return incremental.new_price_returns(bars, since, closed=_closed(tables, bars, since, "price_returns"))

    return rounded(_carried_on(tables, target, "date", incremental.WRITE_DAYS, new), 6, "rolling_30d_volatility")


@registered
def state_price_returns(spark, folder):
    """The state of all histories, made of the stored state up to a day and of the bars after it."""
    tables = _warehouse(spark)
    bars = _bars(spark, folder)
    held = _stored(tables, "state/stock_prices", state.history_state(_known(bars)))
    later = state.history_state(bars.filter(F.col("date") > F.lit(CUTOFF)))
    return _stored(tables, "state/stock_prices", state.merged(held, later))


@registered
def incremental_indicators(spark, folder):
    tables, built = _warehouse(spark), marts(spark, folder)
    feeds_ = [_stored(tables, f"raw/{name}", built.raw[name]) for name in ("stock_prices", "rsi", "macd")]
    target = indicators.technical_indicators(*[_known(f) for f in feeds_])

    def new(since):
        closed = _closed(tables, feeds_[0], since, "technical_indicators")
        return incremental.new_technical_indicators(*feeds_, since, closed=closed)

    return _carried_on(tables, target, "date", incremental.WRITE_DAYS, new)


@registered
def incremental_technical_scores(spark, folder):
    tables = _warehouse(spark)
    table = _stored(tables, "int/technical_indicators", marts(spark, folder).technical_indicators)
    target = scoring.technical_scores(_known(table))

    def new(since):
        return incremental.new_technical_scores(table, since, closed=_closed(tables, table, since, "technical_scores"))

    return _carried_on(tables, target, "date", incremental.WRITE_DAYS, new)


def _since(df: DataFrame, date: str, since) -> DataFrame:
    return df.filter(F.col(date) >= F.lit(since))


@registered
def incremental_composite(spark, folder):
    tables, built = _warehouse(spark), marts(spark, folder)
    technical = _stored(tables, "marts/technical_scores", built.technical_scores)
    fundamental = _stored(tables, "marts/fundamental_scores", built.fundamental_scores)
    target = composite.composite_scores(_known(technical), fundamental)
    new = lambda since: composite.composite_scores(_since(technical, "date", since), fundamental)
    days, keys = incremental.JOIN_DAYS["composite_scores"], ("ticker", "technical_date")
    return cast(_carried_on(tables, target, "technical_date", days, new, keys), "double", *composite.WEIGHTS)


@registered
def incremental_industry(spark, folder):
    tables, built = _warehouse(spark), marts(spark, folder)
    scores, companies_ = _stored(tables, "marts/composite_scores", built.composite_scores), built.companies_current
    target = composite.industry_scores(_known(scores, "technical_date"), companies_)
    new = lambda since: composite.industry_scores(_since(scores, "technical_date", since), companies_, recent=True)
    days, keys = incremental.JOIN_DAYS["industry_scores"], ("ticker", "technical_date")
    return cast(_carried_on(tables, target, "technical_date", days, new, keys), "double", *composite.WEIGHTS)


@registered
def incremental_performance(spark, folder):
    tables, built = _warehouse(spark), marts(spark, folder)
    rows, companies_ = _stored(tables, "int/price_returns", built.price_returns), built.companies_current
    target = composite.price_performance(_known(rows), companies_)
    new = lambda since: composite.price_performance(_since(rows, "date", since), companies_, recent=True)
    carried = _carried_on(tables, target, "date", incremental.JOIN_DAYS["price_performance"], new)
    return rounded(carried, 6, "rolling_30d_volatility")


# ---------------------------------------------------------------------------
# Semantic queries
# ---------------------------------------------------------------------------


def _all_measures(spark, folder, model, dimensions, **options):
    measures = list(MODELS[model].measures)
    result = query(marts(spark, folder).exposed(), model, dimensions, measures, **options)
    inexact = [m for m in measures if m.startswith(("avg_", "std_", "positive_"))]
    result = cast(result, "double", *[m for m in measures if "composite" in m])
    return rounded(result, 6, *inexact)


@registered
def sem_technical(spark, folder):
    return _all_measures(spark, folder, "technical_scores", ["ticker"])


@registered
def sem_technical_monthly(spark, folder):
    return _all_measures(spark, folder, "technical_scores", ["date"], time_grain="month")


@registered
def rollup_technical(spark, folder):
    """All measures by month, quarter and year, merged from one stored rollup per ticker and month."""
    tables, model = _warehouse(spark), "technical_scores"
    rolled = _stored(tables, "rollups/technical", rollup(marts(spark, folder).technical_scores, model, ["ticker"]))
    measures = list(MODELS[model].measures)
    found = [
        from_rollup(rolled, model, ["date"], measures, grain).withColumn("grain", F.lit(grain)) for grain in COARSER
    ]
    inexact = [m for m in measures if m.startswith(("avg_", "std_"))]
    return rounded(reduce(DataFrame.unionByName, found), 6, *inexact)


@registered
def rollup_price(spark, folder):
    """Measures of price performance by sector, and by ticker and year, from one stored rollup."""
    tables, model = _warehouse(spark), "price_performance"
    table = marts(spark, folder).price_performance
    rolled = _stored(tables, "rollups/price", rollup(table, model, ["ticker", "sector"]))
    measures = ["latest_close", "max_drawdown", "ticker_count", "observation_count", "positive_return_rate"]
    by_sector = from_rollup(rolled, model, ["sector"], measures).withColumn("ticker", F.lit(None).cast("string"))
    by_year = from_rollup(rolled, model, ["ticker", "date"], measures, "year")
    both = by_sector.withColumn("date", F.lit(None).cast("date")).unionByName(
        by_year.withColumn("sector", F.lit(None).cast("string"))
    )
    return rounded(both, 6, "positive_return_rate")


@registered
def sem_fundamental(spark, folder):
    return _all_measures(spark, folder, "fundamental_scores", ["fiscal_year"])


@registered
def sem_composite(spark, folder):
    return _all_measures(spark, folder, "composite_scores", ["fiscal_year"])


@registered
def sem_industry(spark, folder):
    return _all_measures(spark, folder, "industry_scores", ["sector", "industry"])


@registered
def sem_price(spark, folder):
    return _all_measures(spark, folder, "price_performance", ["sector"])


@registered
def sem_dimensions_only(spark, folder):
    return query(marts(spark, folder).exposed(), "industry_scores", ["sector", "fiscal_year"])


# ---------------------------------------------------------------------------
# Screens
# ---------------------------------------------------------------------------


def _exposed(spark, folder):
    return marts(spark, folder).exposed()


def _latest(spark, folder, rows=latest.SCORE_ROWS):
    return latest.latest(Raw(spark, folder), rows).exposed()


@registered
def g1_strong_now(spark, folder):
    rows = screens.strong_now(_latest(spark, folder))
    return cast(rows, "double", "composite_score_equal")


@registered
def g2_ticker_performance(spark, folder):
    return screens.ticker_performance(_exposed(spark, folder), "7")


@registered
def g3_best_in_sector(spark, folder):
    rows = screens.best_in_sector(_latest(spark, folder), "ASIA")
    return cast(rows, "double", "composite_score_equal")


@registered
def g4_strong_fundamentals(spark, folder):
    return screens.strong_fundamentals(_exposed(spark, folder))


@registered
def g5_momentum_leaders(spark, folder):
    return screens.momentum_leaders(_latest(spark, folder))


@registered
def g6_risk_adjusted(spark, folder):
    rows = screens.risk_adjusted(_exposed(spark, folder))
    return rounded(rows, 6, "avg_risk_adjusted_return", "avg_return_to_drawdown", "avg_volatility_30d")


@registered
def g7_sector_rotation(spark, folder):
    return rounded(screens.sector_rotation(_exposed(spark, folder)), 6, "avg_composite_equal", "change")


@registered
def g8_rank_by_composite(spark, folder):
    rows = screens.rank_by_composite(_latest(spark, folder))
    return cast(rows, "double", "composite_score_technical_bias")


@registered
def g9_near_high(spark, folder):
    return screens.near_high(_latest(spark, folder, latest.RETURN_ROWS), within=0.9)


@registered
def g10_most_volatile(spark, folder):
    return rounded(screens.most_volatile(_exposed(spark, folder)), 6, "avg_volatility_30d")


@registered
def g11_momentum(spark, folder):
    return screens.momentum(_exposed(spark, folder))


@registered
def g12_mean_reversion(spark, folder):
    return screens.mean_reversion(_exposed(spark, folder))


@registered
def g13_regime_shift(spark, folder):
    return screens.regime_shift(_exposed(spark, folder))


@registered
def g14_risk_off(spark, folder):
    return rounded(screens.risk_off(_exposed(spark, folder)), 6, "rolling_30d_volatility")


@registered
def top_technical(spark, folder):
    """The twenty best technical scores of the last day."""
    rows = latest.latest(Raw(spark, folder)).technical_scores
    return screens.ordered(screens.latest_rows(rows, "date"), ["-technical_score", "ticker"], 20)


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------


@registered
def q_not_null(spark, folder):
    """RSI points without a value."""
    return quality.null_rows(adapters.rsi_points(spark, folder), "rsi_value").select("ticker", "date")


@registered
def q_unique(spark, folder):
    """Tickers that occur in more than one snapshot."""
    return quality.repeated_keys(adapters.tickers_lookup(spark, folder), "ticker")


@registered
def q_composite_grain(spark, folder):
    """Days that two fiscal years claim."""
    return quality.repeated_keys(marts(spark, folder).composite_scores, "ticker", "technical_date")


@registered
def q_score_range(spark, folder):
    """Technical scores outside 0 to 60, to have something to find."""
    return quality.score_out_of_range(marts(spark, folder).technical_scores, "technical_score", high=60)


@registered
def q_fundamentals_range(spark, folder):
    """Fundamental scores outside 30 to 60, to have something to find."""
    rows = marts(spark, folder).fundamental_scores
    return quality.score_out_of_range(rows, "fundamentals_score", low=30, high=60)
