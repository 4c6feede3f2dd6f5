"""Build the model tables in dependency order, incrementally where they allow it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.functions.scalars import as_date, days_before
from quotemill.operators import composite, fundamentals, indicators, quality, returns, scoring
from quotemill.operators.companies import companies_current, companies_snapshot
from quotemill.operators.quality import Rule
from quotemill.operators.timeline import Split
from quotemill.operators.state import history_state, merged
from quotemill.plans import incremental
from quotemill.plans.history import closed_before
from quotemill.plans.marts import EXPOSED, staging
from quotemill.sources.tables import NoTable, Tables

#: Rules hold columns, which need a session: they are made when a build begins.
Check = Callable[[], Rule]


class Source(Mapping[str, DataFrame]):
    """Raw and model tables by name, as they are on disk."""

    def __init__(self, tables: Tables, include_backfill: bool = False):
        self.tables = tables
        self.include_backfill = include_backfill

    def __getitem__(self, name: str) -> DataFrame:
        if name in schemas.RAW_TABLES:
            return self.tables.read(f"raw/{name}", schemas.RAW_TABLES[name])
        return self.tables.read(MODELS[name].path)

    def __contains__(self, name: object) -> bool:
        return name in schemas.RAW_TABLES and self.tables.exists(f"raw/{name}")

    def __iter__(self) -> Iterator[str]:
        return iter([*schemas.RAW_TABLES, *MODELS])

    def __len__(self) -> int:
        return len(schemas.RAW_TABLES) + len(MODELS)

    def staged(self, name: str) -> DataFrame:
        return staging(self, name, self.include_backfill)

    def closed(self, since: dt.date, model: str) -> DataFrame:
        """State of the price histories before the days that an incremental run of a model reads.

        The stored state ends where the run of the model that looks back furthest begins; for the
        others the days from there on are added, which that run reads anyhow.
        """
        kept = ["stock_prices"] + ["stock_prices_backfill"] * self.include_backfill
        sources = [f"raw/{name}" for name in kept if name in self]
        prices = self.staged("stock_prices")
        least = incremental.near_start(since, "price_returns")
        stored = closed_before(self.tables, prices, sources, least)
        start = incremental.near_start(since, model)
        if start <= least:
            return stored
        between = prices.filter((F.col("date") >= as_date(least)) & (F.col("date") < as_date(start)))
        return merged(stored, history_state(between))


@dataclass(frozen=True)
class ModelTable:
    """One table: how to build all of it, and how to build it from a day on."""

    path: str
    full: Callable[[Source, Split | None], DataFrame]
    since: Callable[[Source, Split | None, dt.date], DataFrame] | None = None
    keys: tuple[str, ...] = ()
    date: str | None = None
    read_days: int = incremental.WRITE_DAYS
    checks: tuple[Check, ...] = ()


# -- checks ------------------------------------------------------------------


def not_null(column: str) -> Check:
    return lambda: Rule(f"{column} must not be NULL", F.col(column).isNull())


def unique(column: str) -> Check:
    return lambda: Rule(f"{column} must be unique", unique=column)


def score(column: str) -> Check:
    value = lambda: F.col(column)
    return lambda: Rule(f"{column} must be from 0 to 100", value().isNull() | ~value().between(0, 100))


# -- models ------------------------------------------------------------------


def _price_changes(source, split):
    return returns.daily_price_changes(source.staged("stock_prices"), split)


def _price_changes_since(source, split, since):
    return incremental.new_price_changes(source.staged("stock_prices"), since, split, source.closed(since, "daily_price_changes"))


def _price_returns(source, split):
    return returns.price_returns(source.staged("stock_prices"), split)


def _price_returns_since(source, split, since):
    return incremental.new_price_returns(source.staged("stock_prices"), since, split, source.closed(since, "price_returns"))


def _indicators(source, split):
    feeds = (source.staged(name) for name in ("stock_prices", "rsi", "macd"))
    return indicators.technical_indicators(*feeds, split=split)


def _indicators_since(source, split, since):
    feeds = (source.staged(name) for name in ("stock_prices", "rsi", "macd"))
    return incremental.new_technical_indicators(*feeds, since, split, source.closed(since, "technical_indicators"))


def _fundamentals(source, split):
    names = ("income_statements", "balance_sheets", "cash_flow_statements")
    return fundamentals.fundamentals(*(source.staged(name) for name in names))


def _companies(source, split):
    return companies_current(companies_snapshot(source.staged("tickers_lookup")))


def _technical_scores(source, split):
    return scoring.technical_scores(source["technical_indicators"], split)


def _technical_scores_since(source, split, since):
    return incremental.new_technical_scores(
        source["technical_indicators"], since, split, source.closed(since, "technical_scores")
    )


def _fundamental_scores(source, split):
    return scoring.fundamental_scores(source["fundamentals"])


def _composite(source, split, since=None):
    technical = _from(source["technical_scores"], "date", since)
    return composite.composite_scores(technical, source["fundamental_scores"])


def _industry(source, split, since=None):
    scores = _from(source["composite_scores"], "technical_date", since)
    return composite.industry_scores(scores, source["companies_current"], recent=since is not None)


def _performance(source, split, since=None):
    rows = _from(source["price_returns"], "date", since)
    return composite.price_performance(rows, source["companies_current"], recent=since is not None)


def _from(df: DataFrame, date: str, since: dt.date | None) -> DataFrame:
    return df if since is None else df.filter(F.col(date) >= as_date(since))


daily = partial(ModelTable, keys=("ticker", "date"), date="date")
by_technical_date = partial(ModelTable, keys=("ticker", "technical_date"), date="technical_date")
TICKER = not_null("ticker")
JOIN_DAYS = incremental.JOIN_DAYS

# The raw tables that have a staging view, all of which must have tickers.
STAGED = (
    "tickers_lookup",
    "stock_prices",
    "rsi",
    "macd",
    "news",
    "articles",
    "income_statements",
    "balance_sheets",
    "cash_flow_statements",
)

MODELS: dict[str, ModelTable] = {
    "daily_price_changes": daily(
        "int/daily_price_changes", _price_changes, _price_changes_since, checks=(TICKER,)
    ),
    "price_returns": daily("int/price_returns", _price_returns, _price_returns_since, checks=(TICKER,)),
    "technical_indicators": daily(
        "int/technical_indicators", _indicators, _indicators_since, checks=(TICKER,)
    ),
    "fundamentals": ModelTable("int/fundamentals", _fundamentals, checks=(TICKER,)),
    "companies_current": ModelTable("dim/companies_current", _companies, checks=(TICKER, unique("ticker"))),
    "technical_scores": daily(
        "marts/technical_scores",
        _technical_scores,
        _technical_scores_since,
        checks=(TICKER, not_null("technical_score"), score("technical_score")),
    ),
    "fundamental_scores": ModelTable(
        "marts/fundamental_scores",
        _fundamental_scores,
        checks=(TICKER, not_null("fundamentals_score"), score("fundamentals_score")),
    ),
    "composite_scores": by_technical_date(
        "marts/composite_scores",
        _composite,
        _composite,
        read_days=JOIN_DAYS["composite_scores"],
        checks=(TICKER,),
    ),
    "industry_scores": by_technical_date(
        "marts/industry_scores", _industry, _industry, read_days=JOIN_DAYS["industry_scores"]
    ),
    "price_performance": daily(
        "marts/price_performance",
        _performance,
        _performance,
        read_days=JOIN_DAYS["price_performance"],
        checks=(TICKER,),
    ),
}


def build(
    tables: Tables,
    full_refresh: bool = False,
    check: bool = True,
    include_backfill: bool = False,
    split: Split | None = None,
) -> None:
    """Check the inputs, then build every model in order, checking it as it is written.

    No table is read for a check: inputs were measured when they were written (only commits that
    did not come out clean are looked at again), and a model's rows are measured on their way to
    disk. A batch that breaks a rule is not published, and stops the build.

    A model that has a date is built from its last day on, and merged by its keys; a missing
    table, or ``full_refresh``, means a full build. ``split`` says how to cut histories that are
    too long for a task, in full and incremental builds alike; it never depends on the data.
    """
    source = Source(tables, include_backfill)
    if check:
        for name in STAGED:
            if name in source:
                quality.require_empty(tables.nulls(f"raw/{name}", "ticker"), f"{name}: ticker must not be NULL")
    for name, model in MODELS.items():
        rules = [rule() for rule in model.checks] if check else []
        _write(tables, source, model, split, full_refresh, [replace(r, message=f"{name}: {r.message}") for r in rules])


def _write(
    tables: Tables, source: Source, model: ModelTable, split: Split | None, full: bool, rules: Sequence[Rule]
) -> None:
    last = None
    if model.since is not None and not full and tables.exists(model.path):
        last = tables.last_date(model.path, model.date)
    if last is None:
        tables.overwrite(model.path, model.full(source, split), model.date, rules)
        return
    batch = model.since(source, split, days_before(last, model.read_days))
    tables.delete_insert(model.path, batch, model.keys, model.date, rules)


def exposed(tables: Tables, warn: Callable[[str], None] = print) -> dict[str, DataFrame]:
    """The marts open to semantic queries; one that does not load is left out with a warning."""
    loaded = {}
    for name in EXPOSED:
        try:
            loaded[name] = tables.read(MODELS[name].path)
        except (AnalysisException, NoTable) as error:
            warn(f"could not load {name}: {error}")
    return loaded
