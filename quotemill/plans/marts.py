"""The models as DataFrames over the raw tables, built lazily in dependency order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from quotemill.operators import companies, composite, fundamentals, indicators, returns, scoring

# Columns each staging view passes on. Statements and articles keep the time of
# extraction, the daily market tables drop it.
DROPPED = "extracted_at"
STAGED_WITHOUT_TIME = ("stock_prices", "rsi", "macd", "news")
ROW_KEYS = {"news": ["article_id", "ticker"]}  # others: ticker and date


def staging(raw: Mapping[str, DataFrame], name: str, include_backfill: bool = False) -> DataFrame:
    """Staging view of a raw table.

    ``include_backfill`` adds the backfilled rows whose keys the daily table lacks.
    """
    rows = raw[name]
    if include_backfill and f"{name}_backfill" in raw:
        keys = ROW_KEYS.get(name, ["ticker", "date"])
        rows = rows.unionByName(raw[f"{name}_backfill"].join(rows.select(*keys), keys, "left_anti"))
    return rows.drop(DROPPED) if name in STAGED_WITHOUT_TIME else rows


def create_views(raw: Mapping[str, DataFrame], names: Iterable[str], include_backfill: bool = False) -> None:
    """Staging views for ``spark.sql``, named ``stg_<table>``."""
    for name in names:
        staging(raw, name, include_backfill).createOrReplaceTempView(f"stg_{name}")


@dataclass(frozen=True)
class Marts:
    """All models over a mapping of raw tables; each is planned when first asked for."""

    raw: Mapping[str, DataFrame]
    include_backfill: bool = False

    def _stage(self, name: str) -> DataFrame:
        return staging(self.raw, name, self.include_backfill)

    @cached_property
    def daily_price_changes(self) -> DataFrame:
        return returns.daily_price_changes(self._stage("stock_prices"))

    @cached_property
    def price_returns(self) -> DataFrame:
        return returns.price_returns(self._stage("stock_prices"))

    @cached_property
    def technical_indicators(self) -> DataFrame:
        return indicators.technical_indicators(
            self._stage("stock_prices"), self._stage("rsi"), self._stage("macd")
        )

    @cached_property
    def fundamentals(self) -> DataFrame:
        return fundamentals.fundamentals(
            self._stage("income_statements"),
            self._stage("balance_sheets"),
            self._stage("cash_flow_statements"),
        )

    @cached_property
    def companies_snapshot(self) -> DataFrame:
        return companies.companies_snapshot(self._stage("tickers_lookup"))

    @cached_property
    def companies_current(self) -> DataFrame:
        return companies.companies_current(self.companies_snapshot)

    @cached_property
    def technical_scores(self) -> DataFrame:
        return scoring.technical_scores(self.technical_indicators)

    @cached_property
    def fundamental_scores(self) -> DataFrame:
        return scoring.fundamental_scores(self.fundamentals)

    @cached_property
    def composite_scores(self) -> DataFrame:
        return composite.composite_scores(self.technical_scores, self.fundamental_scores)

    @cached_property
    def industry_scores(self) -> DataFrame:
        return composite.industry_scores(self.composite_scores, self.companies_current)

    @cached_property
    def price_performance(self) -> DataFrame:
        return composite.price_performance(self.price_returns, self.companies_current)

    def exposed(self) -> Mapping[str, DataFrame]:
        """The tables open to semantic queries, and no others."""
        return _Exposed(self)


# The only tables semantic queries may see.
EXPOSED = (
    "composite_scores",
    "industry_scores",
    "fundamental_scores",
    "technical_scores",
    "price_performance",
)


class _Exposed(Mapping[str, DataFrame]):
    def __init__(self, marts: Marts):
        self._marts = marts

    def __getitem__(self, name: str) -> DataFrame:
        if name not in EXPOSED:
            raise KeyError(name)
        return getattr(self._marts, name)

    def __iter__(self):
        return iter(EXPOSED)

    def __len__(self) -> int:
        return len(EXPOSED)
