"""The engine's tables derived from the order, supplier, document and event tables.

A supplier plays the part of a ticker and its order lines that of trades. Money is summed in
whole cents, so results do not depend on the order of summation. Every table is aggregated to its
grain first: partial sums are formed before the shuffle, so a supplier with very many lines still
sends few rows, and a ticker has at most one row per day afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill import schemas

SNAPSHOT_DATES = ("2001-10-01", "2001-11-01")
NEWS_DATES = ("2024-05-01", "2024-05-02")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _trades(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as trades. Grouping is by the numeric supplier key, which hashes faster than text."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_suppkey AS supplier",
        "CAST(l_shipdate AS DATE) AS date",
        "floor(l_extendedprice * 100D + 0.5D) AS cents",
        "CAST(l_quantity AS BIGINT) AS shares",
        "floor(l_discount * 100D + 0.5D) AS discount",
        "floor(l_tax * 100D + 0.5D) AS tax",
        "l_linenumber AS line",
        "l_returnflag AS flag",
    )


TICKER = "CAST(supplier AS STRING) AS ticker"
POINT_LABELS = ("'day' AS timespan", "'close' AS series_type", "date")

# Cents per share rounded half up, in whole-number arithmetic.
PER_SHARE = "(2 * cents + shares) div (2 * shares)"


def stock_prices(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per ticker and day."""
    daily = (
        _trades(spark, folder)
        .groupBy("supplier", "date")
        .agg(
            F.expr(f"min({PER_SHARE}) / 100D AS low"),
            F.expr(f"max({PER_SHARE}) / 100D AS high"),
            F.expr("sum(cents) AS cents"),
            F.expr("sum(shares) AS shares"),
            F.expr("count(*) AS transactions"),
        )
    )
    return daily.selectExpr(
        TICKER,
        "low AS open",
        "high",
        "low",
        f"{PER_SHARE} / 100D AS close",
        "shares AS volume",
        f"{PER_SHARE} / 100D AS vwap",
        "transactions",
        "date",
    )


def _daily_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _trades(spark, folder).groupBy("supplier", "date").agg(F.expr("sum(shares) AS shares"))


def rsi_points(spark: SparkSession, folder: str) -> DataFrame:
    return _daily_shares(spark, folder).selectExpr(
        TICKER,
        "CAST(date AS TIMESTAMP_NTZ) AS timestamp",
        "CASE WHEN shares % 13 <> 0 THEN CAST((shares * 7) % 101 AS DOUBLE) END AS rsi_value",
        "14 AS window_size",
        *POINT_LABELS,
    )


def macd_points(spark: SparkSession, folder: str) -> DataFrame:
    value, signal = "(shares % 21 - 10) / 10D", "(shares % 17 - 8) / 10D"
    return _daily_shares(spark, folder).selectExpr(
        TICKER,
        "CAST(date AS TIMESTAMP_NTZ) AS timestamp",
        f"{value} AS macd_value",
        f"{signal} AS signal_value",
        f"{value} - {signal} AS histogram_value",
        "12 AS short_window",
        "26 AS long_window",
        "9 AS signal_window",
        *POINT_LABELS,
    )


def _statements(
    spark: SparkSession, folder: str, schema: T.StructType, sums: dict[str, str], amounts: dict[str, str]
) -> DataFrame:
    """One statement per ticker and calendar year: conditional sums, and amounts made of them."""
    lines = _trades(spark, folder).withColumn("year", F.year("date"))
    yearly = lines.groupBy("supplier", "year").agg(
        *[
            F.expr(f"coalesce(sum(cents) FILTER (WHERE {condition}), 0) AS {name}")
            for name, condition in sums.items()
        ],
        F.expr("count(*) AS lines"),
    )
    return yearly.selectExpr(
        TICKER,
        "make_date(year, 12, 31) AS date",
        "CAST(year AS STRING) AS fiscal_year",
        "'FY' AS period",
        *[f"CAST({value} AS {schema[name].dataType.simpleString()}) AS {name}" for name, value in amounts.items()],
    )


def income_statements(spark: SparkSession, folder: str) -> DataFrame:
    return _statements(
        spark,
        folder,
        schemas.INCOME,
        sums={
            "total": "true",
            "gross": "flag <> 'R'",
            "accepted": "flag = 'A'",
            "gains": "flag = 'A' AND discount <= 5",
            "losses": "flag = 'R' AND tax = 8",
        },
        amounts={
            "revenue": "total",
            "cost_of_revenue": "total - gross",
            "gross_profit": "gross",
            "operating_income": "accepted",
            "net_income": "gains - losses",
            "ebitda": "NULL",
            "eps_diluted": "(gains - losses) / lines",
            "weighted_average_shares_out_diluted": "lines",
        },
    )


def balance_sheets(spark: SparkSession, folder: str) -> DataFrame:
    equity = "(low_discount - 2 * untaxed) * 5"
    return _statements(
        spark,
        folder,
        schemas.BALANCE,
        sums={
            "total": "true",
            "current_assets": "line <= 3",
            "current_liabilities": "line >= 5",
            "low_discount": "discount < 5",
            "untaxed": "tax = 0",
            "taxed": "tax >= 6",
            "cash": "line = 1",
            "receivables": "line = 2",
        },
        amounts={
            "total_assets": "total * 3",
            "total_current_assets": "current_assets",
            "cash_and_short_term_investments": "cash",
            "net_receivables": "receivables",
            "total_liabilities": f"total * 3 - {equity}",
            "total_current_liabilities": "current_liabilities",
            "total_stockholders_equity": equity,
            "total_debt": "taxed * 3",
            "net_debt": "taxed * 3 - cash",
        },
    )


def cash_flow_statements(spark: SparkSession, folder: str) -> DataFrame:
    free = "(inflow - outflow)"
    return _statements(
        spark,
        folder,
        schemas.CASH_FLOW,
        sums={
            "inflow": "flag = 'N' AND line <= 4",
            "outflow": "flag = 'R' AND line = 1",
            "investment": "line = 7",
        },
        amounts={
            "free_cash_flow": free,
            "operating_cash_flow": f"{free} + investment",
            "capital_expenditure": "-investment",
        },
    )


def constituents(spark: SparkSession, folder: str) -> DataFrame:
    """Every supplier under the headers of the constituents file."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    placed = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.selectExpr(
        "CAST(s_suppkey AS STRING) AS Symbol",
        "s_name AS Security",
        "r_name AS `GICS Sector`",
        "n_name AS `GICS Sub-Industry`",
        "concat(n_name, ', ', r_name) AS `Headquarters Location`",
        "CAST(date_add(DATE'1990-01-01', CAST(floor(s_acctbal) AS INT)) AS STRING) AS `Date added`",
        "lpad(CAST(s_suppkey AS STRING), 10, '0') AS CIK",
        "CAST(1900 + s_nationkey AS STRING) AS Founded",
        "s_acctbal",
    )


def tickers_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots of the index; suppliers in debt leave it before the second."""
    first, second = (f"DATE'{day}'" for day in SNAPSHOT_DATES)
    named = constituents(spark, folder).withColumnsRenamed(schemas.CONSTITUENT_HEADERS)
    return named.selectExpr(
        "ticker",
        "security_name",
        "gics_sector",
        "gics_sub_industry",
        "headquarters_location",
        "CAST(date_added AS DATE) AS date_added",
        "cik",
        "founded_year",
        f"explode(CASE WHEN s_acctbal >= 0 THEN array({first}, {second}) ELSE array({first}) END) AS date",
        "CAST(NULL AS TIMESTAMP_NTZ) AS extracted_at",
    )


def article_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles that mention two exchange-prefixed tickers; English ones come first."""
    return table(spark, folder, "documents").selectExpr(
        f"concat(CASE WHEN lang = 'en' THEN '{NEWS_DATES[0]}' ELSE '{NEWS_DATES[1]}' END, ' 09:30:00') AS date",
        "concat('NYSE:', doc_id % 10, ', NASDAQ:', (doc_id * 3) % 10) AS tickers",
        "concat('Document ', doc_id) AS title",
        "text AS content",
        "CAST(NULL AS STRING) AS image",
        "concat('doc/', doc_id) AS link",
        "CAST(NULL AS STRING) AS author",
        "source AS site",
    )
