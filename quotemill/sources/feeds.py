"""Landed feed files → typed rows.

Each function takes the payloads of one feed as a DataFrame, as :func:`read_feed` returns them,
and maps them to the columns of its raw table. A payload is what one request for one ticker
returned, with the ticker added. Lines that bring no rows drop out; :func:`read_rejects` has them,
each with the reason.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill import schemas
from quotemill.functions.scalars import (
    as_date,
    before_end_of_day,
    epoch_millis,
    iso_timestamp,
    json_text,
    mentioned_tickers,
    statement_timestamp,
)
from quotemill.operators.companies import in_universe
from quotemill.operators.topk import latest_k

Day = str | dt.date


def read_feed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a fixed schema: no inference pass over the files."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def parsed(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(p, reason, line) of the ``line`` texts, in one parse.

    ``reason`` is NULL for payloads that are as they should be. ``broken``: not the JSON of a
    payload. ``partial``: some field is not of its type, and NULL; the rest is used. ``status``: the
    provider reported a failure. ``empty``: no results. The text is kept where there is a reason.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kept = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    read = lines.select("line", F.from_json("line", kept, {"columnNameOfCorruptRecord": "_broken"}).alias("p"))
    broken = F.col("p").isNull() | F.col("p._broken").isNotNull()
    none = F.lit(False)
    if "results" in schema.names:
        results = F.col("p.results")
        if isinstance(schema["results"].dataType, T.StructType):
            results = results["values"]
        none = F.coalesce(F.size(results), F.lit(-1)) <= 0
    else:
        held = [F.col(f"p.{name}").isNotNull() for name in schema.names]
        none = ~reduce(lambda x, y: x | y, held)
    failed = F.coalesce(F.col("p.status") != "OK", F.lit(True)) if "status" in schema.names else F.lit(False)
    reason = (
        F.when(broken & (failed | none), "broken")
        .when(failed, "status")
        .when(none, "empty")
        .when(broken, "partial")
    )
    return read.select("p", reason.alias("reason"), "line").withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))


def payloads(read: DataFrame) -> DataFrame:
    """The payloads of ``parsed`` lines that bring rows."""
    used = read.filter(F.col("reason").isNull() | (F.col("reason") == "partial"))
    return used.select("p.*").drop("_broken")


def rejects(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(line, reason) of the ``line`` texts that are not as they should be."""
    return rejected(parsed(lines, schema))


def rejected(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNotNull()).select("line", "reason")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_rejects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return rejects(read_lines(spark, path), schema)


def read_constituents(spark: SparkSession, path: str, reasons: bool = False) -> DataFrame:
    """The members file; with ``reasons``, lines of another number of fields, or without a ticker,
    are told apart as ``parsed`` does it, under the columns ``reason`` and ``line``."""
    reader = spark.read.option("header", True)
    if not reasons:
        return reader.schema(schemas.CONSTITUENT_FEED).csv(path)
    kept = T.StructType([*schemas.CONSTITUENT_FEED.fields, T.StructField("line", T.StringType())])
    read = reader.schema(kept).option("columnNameOfCorruptRecord", "line").csv(path)
    nameless = F.coalesce(F.trim(schemas.CONSTITUENT_FEED.names[0]), F.lit("")) == ""
    fields = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in schemas.CONSTITUENT_FEED.names])
    reason = F.when(nameless & F.col("line").isNotNull(), "broken").when(nameless, "empty").when(F.col("line").isNotNull(), "partial")
    return read.withColumn("reason", reason).withColumn("line", F.when(F.col("reason").isNotNull(), F.coalesce("line", fields)))


def accepted(payloads: DataFrame) -> DataFrame:
    return payloads.filter(F.col("status") == "OK")


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def shape(rows: DataFrame, table: T.StructType) -> DataFrame:
    """Columns by name, in the order and types of a table."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table])


# ---------------------------------------------------------------------------
# Price bars
# ---------------------------------------------------------------------------


def _bars(payloads: DataFrame, date: Column) -> DataFrame:
    bars = accepted(payloads).select("ticker", F.explode("results").alias("r"))
    return bars.select(
        "ticker",
        F.col("r.o").alias("open"),
        F.col("r.h").alias("high"),
        F.col("r.l").alias("low"),
        F.col("r.c").alias("close"),
        F.col("r.v").try_cast("bigint").alias("volume"),
        F.col("r.vw").alias("vwap"),
        F.col("r.n").alias("transactions"),
        date.alias("date"),
        _now().alias("extracted_at"),
    )


def stock_prices(payloads: DataFrame, run_date: Day) -> DataFrame:
    """One day's bars, stamped with that day."""
    return _bars(payloads, as_date(run_date))


def stock_prices_range(payloads: DataFrame) -> DataFrame:
    """Bars of a date range, dated by their own time (UTC); NULL where they carry none."""
    return _bars(payloads, epoch_millis(F.col("r.t")).cast("date"))


# ---------------------------------------------------------------------------
# Indicator points
# ---------------------------------------------------------------------------


def _points(
    payloads: DataFrame,
    run_date: Day,
    limit: int | None,
    values: dict[str, str],
    constants: dict[str, object],
    stamp_run_date: bool,
) -> DataFrame:
    """The newest ``limit`` points per ticker up to the end of the run date; None takes all."""
    points = accepted(payloads).select("ticker", F.explode("results.values").alias("v"))
    typed = points.select(
        "ticker",
        epoch_millis(F.col("v.timestamp")).alias("timestamp"),
        *[F.col(f"v.{field}").alias(name) for name, field in values.items()],
    )
    stamp = F.col("timestamp")
    known = typed.filter(stamp.isNull() | before_end_of_day(stamp, run_date))
    names = list(values)
    newest = latest_k(
        known,
        limit,
        newest=[stamp.desc_nulls_last(), *[F.col(n).desc_nulls_last() for n in names]],
        spread=["timestamp", *names],
    )
    return newest.select(
        "ticker",
        "timestamp",
        *names,
        *[F.lit(value).alias(name) for name, value in constants.items()],
        F.lit("close").alias("series_type"),
        (as_date(run_date) if stamp_run_date else stamp.cast("date")).alias("date"),
        _now().alias("extracted_at"),
    )


def indicator(
    payloads: DataFrame,
    run_date: Day,
    name: str,
    window: int,
    timespan: str = "day",
    limit: int | None = None,
    stamp_run_date: bool = True,
) -> DataFrame:
    """Points of a one-value indicator (``sma`` or ``rsi``).

    Rows carry the run date, also when the point is older; ``stamp_run_date=False`` dates each
    row by its own time instead.
    """
    constants = {"window_size": window, "timespan": timespan}
    return _points(payloads, run_date, limit, {f"{name}_value": "value"}, constants, stamp_run_date)


def macd(
    payloads: DataFrame,
    run_date: Day,
    short_window: int = 12,
    long_window: int = 26,
    signal_window: int = 9,
    timespan: str = "day",
    limit: int | None = None,
    stamp_run_date: bool = True,
) -> DataFrame:
    values = {"macd_value": "value", "signal_value": "signal", "histogram_value": "histogram"}
    constants = {
        "short_window": short_window,
        "long_window": long_window,
        "signal_window": signal_window,
        "timespan": timespan,
    }
    return _points(payloads, run_date, limit, values, constants, stamp_run_date)


# ---------------------------------------------------------------------------
# News
# ---------------------------------------------------------------------------


def _news(payloads: DataFrame, wanted: Column, date: Column, limit: int | None) -> DataFrame:
    """Articles of the wanted days, or the newest ``limit`` of them per ticker, publisher flattened."""
    results = accepted(payloads).select("ticker", F.explode("results").alias("a"))
    published = results.withColumn("published_utc", iso_timestamp(F.col("a.published_utc")))
    flat = published.filter(wanted).select(
        "ticker",
        F.col("a.id").alias("article_id"),
        F.col("a.publisher.name").alias("publisher_name"),
        F.col("a.publisher.homepage_url").alias("publisher_homepage_url"),
        F.col("a.publisher.logo_url").alias("publisher_logo_url"),
        F.col("a.title").alias("title"),
        F.col("a.author").alias("author"),
        "published_utc",
        F.col("a.article_url").alias("article_url"),
        json_text(F.col("a.tickers")).alias("tickers"),
        F.col("a.image_url").alias("image_url"),
        F.col("a.description").alias("description"),
        json_text(F.col("a.keywords")).alias("keywords"),
        date.alias("date"),
        _now().alias("extracted_at"),
    )
    order = [F.col("published_utc").desc_nulls_last(), F.col("article_id").asc_nulls_last()]
    return latest_k(flat, limit, newest=order, spread=["published_utc", "article_id"])


def news(payloads: DataFrame, run_date: Day, limit_per_ticker: int | None = None) -> DataFrame:
    """One day's articles, stamped with that day. List fields are JSON text."""
    on_day = F.col("published_utc").cast("date") == as_date(run_date)
    return _news(payloads, on_day, as_date(run_date), limit_per_ticker)


def news_range(payloads: DataFrame, start: Day, end: Day, limit_per_ticker: int | None = None) -> DataFrame:
    """Articles from ``start`` to ``end``, dated by their time of publication."""
    day = F.col("published_utc").cast("date")
    return _news(payloads, day.between(as_date(start), as_date(end)), day, limit_per_ticker)


def with_variants(rows: DataFrame, *columns: str) -> DataFrame:
    """JSON text columns parsed into variants; NULL where a text is no JSON."""
    return rows.withColumns({c: F.try_parse_json(F.col(c)) for c in columns})


def articles(feed: DataFrame, run_date: Day, members: DataFrame) -> DataFrame:
    """Articles of exactly one day, one row per mentioned ticker of the universe.

    A ticker mentioned twice gives two rows.
    """
    on_day = feed.filter(F.substring("date", 1, 10) == F.lit(str(run_date)))
    mentions = on_day.withColumn("ticker", F.explode(mentioned_tickers(F.col("tickers"))))
    return in_universe(mentions, members).select(
        "ticker",
        "title",
        as_date(run_date).alias("date"),
        "content",
        F.col("tickers").alias("article_tickers"),
        F.col("image").alias("image_url"),
        F.col("link").alias("article_url"),
        "author",
        "site",
        _now().alias("extracted_at"),
    )


# ---------------------------------------------------------------------------
# Statements, constituents, reference tickers
# ---------------------------------------------------------------------------


def _statements(payloads: DataFrame, amounts: list[str], table: T.StructType) -> DataFrame:
    records = payloads.select("ticker", F.explode("results").alias("r"))
    fields = {f.name: F.col("r." + schemas.feed_name(f.name)) for f in schemas.STATEMENT_HEAD if f.name != "ticker"}
    fields |= {a: F.col("r." + schemas.feed_name(a)) for a in amounts}
    for day in ("date", "filing_date"):
        fields[day] = fields[day].try_cast("date")
    fields["accepted_date"] = statement_timestamp(fields["accepted_date"])
    rows = records.select(
        "ticker", *[value.alias(name) for name, value in fields.items()], _now().alias("extracted_at")
    )
    return shape(rows, table)


def income_statements(payloads: DataFrame) -> DataFrame:
    return _statements(payloads, schemas.INCOME_AMOUNTS, schemas.INCOME)


def balance_sheets(payloads: DataFrame) -> DataFrame:
    return _statements(payloads, schemas.BALANCE_AMOUNTS, schemas.BALANCE)


def cash_flow_statements(payloads: DataFrame) -> DataFrame:
    return _statements(payloads, schemas.CASH_FLOW_AMOUNTS, schemas.CASH_FLOW)


def constituents(snapshot: DataFrame, run_date: Day) -> DataFrame:
    """Index members of a day under their column names."""
    renamed = snapshot.withColumnsRenamed(schemas.CONSTITUENT_HEADERS)
    rows = renamed.withColumns(
        {
            "date_added": F.col("date_added").try_cast("date"),
            "date": as_date(run_date),
            "extracted_at": _now(),
        }
    )
    return shape(rows, schemas.CONSTITUENTS)


def reference_tickers(pages: DataFrame) -> DataFrame:
    """The provider's ticker list, all pages together."""
    return accepted(pages).select(F.explode("results").alias("r")).select("r.*")
