"""Index membership: snapshots, the latest snapshot and the universe of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.scalars import as_date

BROADCAST_MEMBERS = 100_000  # members that every task may hold; beyond, the join is shuffled
BROADCAST_COMPANIES = 500_000  # companies with their names that every task may hold

# Names the membership table takes in the models.
SNAPSHOT_NAMES = {
    "date": "as_of_date",
    "security_name": "company_name",
    "gics_sector": "sector",
    "gics_sub_industry": "industry",
    "headquarters_location": "location",
}

DIMENSION_COLUMNS = """
    as_of_date ticker company_name sector industry location cik founded_year date_added
    date_added_year extracted_at
""".split()


def companies_snapshot(lookup: DataFrame) -> DataFrame:
    """Daily membership snapshots under their model names, with the year of joining."""
    return lookup.withColumnsRenamed(SNAPSHOT_NAMES).withColumn("date_added_year", F.year("date_added"))


def companies_current(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot only. The date comes from a scalar subquery, not from the driver."""
    latest = snapshots.agg(F.max("as_of_date")).scalar()
    return snapshots.filter(F.col("as_of_date") == latest).select(*DIMENSION_COLUMNS)


def universe(lookup: DataFrame, run_date: str | dt.date) -> DataFrame:
    """Distinct tickers of one day's snapshot. Stays distributed."""
    return (
        lookup.filter(F.col("date") == as_date(run_date))
        .select("ticker")
        .filter(F.col("ticker").isNotNull())
        .distinct()
    )


def in_universe(
    rows: DataFrame, members: DataFrame, shares: int = 1, spread: Sequence[str] = ()
) -> DataFrame:
    """Rows whose ticker is a member.

    Members are counted. Few are broadcast, so the rows are not shuffled at all, whatever the
    planner thinks of the plan behind the members. Beyond ``BROADCAST_MEMBERS`` both sides are
    shuffled by ticker; ``shares`` then spreads each ticker by a hash of the narrow columns
    ``spread``, and gives every share its own copy of the members, so no task takes a whole ticker.
    """
    if shares > 1 and not spread:
        raise ValueError("name the columns that tell the shares apart")
    known = members.filter(F.col("ticker").isNotNull()).select("ticker")
    if known.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS:
        return rows.join(F.broadcast(known), "ticker", "left_semi")
    if shares <= 1:
        return rows.join(known, "ticker", "left_semi")
    share = F.pmod(F.xxhash64(*spread), F.lit(shares))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))
    copies = known.withColumn("_share", F.explode(every))
    # One key column: with two, both sides might be partitioned by the ticker alone.
    key = F.struct("ticker", "_share").alias("_key")
    shared = rows.withColumn("_share", share).select("*", key)
    return shared.join(copies.select(key), "_key", "left_semi").select(*rows.columns)


def named(companies: DataFrame, most: int | None = None) -> DataFrame:
    """Ticker, name, sector and industry of ``companies``, to be joined with daily rows.

    They are counted. Up to ``most``, by default ``BROADCAST_COMPANIES``, are broadcast, so the daily
    rows are not shuffled for them; beyond, the join is left to the planner. The driver holds what is
    broadcast, about 200 bytes a company.
    """
    most = BROADCAST_COMPANIES if most is None else most
    names = companies.select("ticker", "company_name", "sector", "industry")
    few = names.select("ticker").limit(most + 1).count() <= most
    return F.broadcast(names) if few else names


def with_company(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Company name, sector and industry of each ticker; NULL for tickers that left the index."""
    return rows.join(companies.select("ticker", "company_name", "sector", "industry"), "ticker", "left")
