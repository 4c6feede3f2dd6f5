"""Measures over the marts: ``query`` groups, aggregates, filters, sorts and limits one model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


class Measure:
    """An aggregate over rows, and the same by way of states that merge.

    ``states`` are formed from rows, ``merged`` from states of the same names, and ``result`` reads
    them. ``states`` of some rows, merged with those of others, are the states of both.
    """

    def __call__(self) -> Column:
        raise NotImplementedError

    def states(self) -> dict[str, Column]:
        raise NotImplementedError

    def merged(self, state: Callable[[str], Column]) -> dict[str, Column]:
        """Sums, unless a measure says otherwise."""
        return {name: F.sum(state(name)) for name in self.states()}

    def result(self, state: Callable[[str], Column]) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Mean(Measure):
    """Average as sum over count: whole and decimal columns are summed exactly."""

    value: Callable[[], Column]

    def __call__(self):
        return F.try_divide(F.sum(self.value()).cast("double"), F.count(self.value()))

    def states(self):
        return {"sum": F.sum(self.value()), "n": F.count(self.value())}

    def result(self, state):
        return F.try_divide(state("sum").cast("double"), state("n"))


@dataclass(frozen=True)
class Extreme(Measure):
    column: str
    function: Callable[[Column], Column]

    def __call__(self):
        return self.function(F.col(self.column))

    def states(self):
        return {"value": self()}

    def merged(self, state):
        return {"value": self.function(state("value"))}

    def result(self, state):
        return state("value")


@dataclass(frozen=True)
class Spread(Measure):
    """Sample standard deviation; its states are count, mean and squared distance from the mean."""

    column: str

    def __call__(self):
        return F.stddev_samp(self.column)

    def states(self):
        n = F.count(self.column)
        return {"n": n, "mean": F.avg(self.column).cast("double"), "apart": (F.var_pop(self.column) * n).cast("double")}

    def merged(self, state):
        n, mean = state("n"), state("mean")
        total = F.sum(n * mean)
        between = F.sum(n * mean * mean) - F.try_divide(total * total, F.sum(n))
        return {"n": F.sum(n), "mean": F.try_divide(total, F.sum(n)), "apart": F.sum(state("apart")) + between}

    def result(self, state):
        return F.when(state("n") > 1, F.sqrt(F.greatest(state("apart"), F.lit(0.0)) / (state("n") - 1)))


@dataclass(frozen=True)
class Rows(Measure):
    def __call__(self):
        return F.count(F.lit(1))

    def states(self):
        return {"n": self()}

    def result(self, state):
        return state("n")


@dataclass(frozen=True)
class Distinct(Measure):
    """Number of different values, exact unless the query asks for an approximation.

    Its state is a sketch of at most some 4,096 counters: exact in practice for some hundreds of
    values, within about two percent beyond.
    """

    column: str

    def __call__(self):
        return F.countDistinct(self.column)

    def approximate(self) -> Column:
        return F.approx_count_distinct(self.column)

    def states(self):
        return {"sketch": F.hll_sketch_agg(self.column, F.lit(12))}

    def merged(self, state):
        return {"sketch": F.hll_union_agg(state("sketch"))}

    def result(self, state):
        return F.coalesce(F.hll_sketch_estimate(state("sketch")), F.lit(0).cast("long"))


def mean(column: str) -> Measure:
    return Mean(lambda: F.col(column))


def mean_of(value: Callable[[], Column]) -> Measure:
    return Mean(value)


def high(column: str) -> Measure:
    return Extreme(column, F.max)


def low(column: str) -> Measure:
    return Extreme(column, F.min)


def spread(column: str) -> Measure:
    return Spread(column)


def rows() -> Measure:
    return Rows()


@dataclass(frozen=True)
class Model:
    dimensions: tuple[str, ...]
    time_dimension: str
    measures: Mapping[str, Measure]


def _score_measures(name: str, column: str) -> dict[str, Measure]:
    return {
        f"avg_{name}": mean(column),
        f"max_{name}": high(column),
        f"min_{name}": low(column),
        f"std_{name}": spread(column),
    }


def _means(*columns: str) -> dict[str, Measure]:
    return {f"avg_{c}": mean(c) for c in columns}


def _composite_measures() -> dict[str, Measure]:
    return {
        **_score_measures("composite_equal", "composite_score_equal"),
        "avg_composite_technical_bias": mean("composite_score_technical_bias"),
        "avg_composite_fundamental_bias": mean("composite_score_fundamental_bias"),
        **_means("technical_score", "fundamentals_score"),
    }


COUNTS: dict[str, Measure] = {"ticker_count": Distinct("ticker"), "observation_count": rows()}

# Models, their dimensions and the names and meaning of their measures.
MODELS: dict[str, Model] = {
    "technical_scores": Model(
        ("ticker", "date"),
        "date",
        {
            **_score_measures("technical_score", "technical_score"),
            **_means("trend_score", "momentum_score", "price_action_score", "macd_score"),
            **COUNTS,
        },
    ),
    "fundamental_scores": Model(
        ("ticker", "date", "fiscal_year"),
        "date",
        {
            **_score_measures("fundamentals_score", "fundamentals_score"),
            **_means(
                "profitability_score",
                "growth_score",
                "financial_health_score",
                "cash_quality_score",
                "gross_margin",
                "operating_margin",
                "net_margin",
                "return_on_equity",
                "current_ratio",
                "debt_to_equity",
                "revenue_growth_yoy",
            ),
            "ticker_count": Distinct("ticker"),
        },
    ),
    "composite_scores": Model(
        ("ticker", "technical_date", "fiscal_year"),
        "technical_date",
        {**_composite_measures(), **COUNTS},
    ),
    "industry_scores": Model(
        ("ticker", "company_name", "sector", "industry", "technical_date", "fiscal_year"),
        "technical_date",
        {
            **_composite_measures(),
            "ticker_count": Distinct("ticker"),
            "sector_count": Distinct("sector"),
        },
    ),
    "price_performance": Model(
        ("ticker", "company_name", "sector", "industry", "date"),
        "date",
        {
            **_means(
                "daily_return",
                "cumulative_return",
                "rolling_30d_return",
                "rolling_90d_return",
                "rolling_1y_return",
            ),
            "latest_cumulative_return": high("cumulative_return"),
            "avg_volatility_30d": mean("rolling_30d_volatility"),
            "positive_return_rate": mean_of(lambda: (F.col("daily_return") > 0).cast("int")),
            "avg_risk_adjusted_return": mean_of(
                lambda: F.try_divide("rolling_1y_return", "rolling_30d_volatility")
            ),
            "avg_drawdown": mean("drawdown_pct"),
            "max_drawdown": low("drawdown_pct"),
            "avg_return_to_drawdown": mean_of(
                lambda: F.try_divide(F.col("rolling_1y_return"), F.abs("drawdown_pct"))
            ),
            "latest_close": high("close"),
            **COUNTS,
        },
    ),
}


# What each model is about.
ABOUT = {
    "technical_scores": "trend, momentum, price action and MACD scores of a stock on a day",
    "fundamental_scores": "profitability, growth, health and cash scores of a stock in a fiscal year",
    "composite_scores": "technical and fundamental scores of a stock on a day, blended",
    "industry_scores": "composite scores with the company, its sector and its industry",
    "price_performance": "returns, volatility and drawdown of a stock on a day, with its company",
}
MEANINGS = {
    "avg_": "mean of {}",
    "max_": "largest {}",
    "min_": "smallest {}",
    "std_": "sample standard deviation of {}",
    "latest_": "largest {} of the rows at hand",
    "positive_": "share of rows with a positive {}",
}


def describe(model: str | None = None) -> list[dict[str, str]]:
    """What can be asked for: a row per dimension and measure of one model, or of all."""
    if model is not None and model not in MODELS:
        raise ValueError(f"unknown model {model!r}; known: {sorted(MODELS)}")
    rows = []
    for name in [model] if model else MODELS:
        spec = MODELS[name]
        for dimension in spec.dimensions:
            kind = "time dimension" if dimension == spec.time_dimension else "dimension"
            rows.append({"model": name, "about": ABOUT[name], "name": dimension, "kind": kind, "meaning": dimension})
        for measure in spec.measures:
            rows.append(
                {"model": name, "about": ABOUT[name], "name": measure, "kind": "measure", "meaning": _meaning(measure)}
            )
    return rows


def _meaning(measure: str) -> str:
    if measure.endswith("_count"):
        counted = measure.removesuffix("_count")
        return "number of rows" if counted == "observation" else f"number of different values of {counted}"
    prefix = next(p for p in MEANINGS if measure.startswith(p))
    return MEANINGS[prefix].format(measure.removeprefix(prefix).replace("_", " "))


def latest_rows(table: DataFrame, date: str, not_after: str | None = None) -> DataFrame:
    """Rows of the last date in the table, or of the last date up to ``not_after``.

    The date is a scalar subquery over one column; nothing comes to the driver.
    """
    considered = table if not_after is None else table.filter(F.col(date) <= F.lit(not_after).cast("date"))
    return table.filter(F.col(date) == considered.agg(F.max(date)).scalar())


def ordered(df: DataFrame, order_by: Sequence[str], limit: int | None = None) -> DataFrame:
    """Sort by names, ``-name`` for descending, NULLs last; with a limit, keep the first rows."""
    keys = [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order_by
    ]
    done = df.orderBy(*keys) if keys else df
    return done if limit is None else done.limit(limit)


def query(
    tables: Mapping[str, DataFrame],
    model: str,
    dimensions: Sequence[str] = (),
    measures: Sequence[str] = (),
    filters: Sequence[Column | str] | Mapping[str, object] = (),
    order_by: Sequence[str] = (),
    limit: int | None = None,
    time_grain: str | None = None,
    approximate: bool = False,
    latest: bool = False,
) -> DataFrame:
    """Measures of a model per combination of dimensions.

    ``filters`` are conditions, or a mapping of columns to wanted values. ``latest`` keeps the
    last date of the whole table only. ``time_grain`` truncates the time dimension. ``order_by`` takes
    output names, ``-name`` for descending, with the dimensions as tie-breakers. Without measures
    the result is the distinct combinations of dimensions.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; known: {sorted(MODELS)}")
    if model not in tables:
        raise ValueError(f"the table of model {model!r} is not loaded")
    spec = MODELS[model]
    unknown = [d for d in dimensions if d not in spec.dimensions]
    unknown += [m for m in measures if m not in spec.measures]
    if unknown:
        raise ValueError(f"model {model!r} has no {', '.join(unknown)}")
    if not dimensions and not measures:
        raise ValueError("a query needs at least one dimension or measure")
    if time_grain is not None and time_grain not in GRAINS:
        raise ValueError(f"time_grain must be one of {GRAINS}")

    table = tables[model]
    if latest:
        table = latest_rows(table, spec.time_dimension)
    if isinstance(filters, Mapping):
        filters = [F.col(name) == value for name, value in filters.items()]
    for condition in filters:
        table = table.filter(condition)
    if time_grain is not None:
        truncated = F.date_trunc(time_grain, spec.time_dimension).cast("date")
        table = table.withColumn(spec.time_dimension, truncated)

    grouped = table.groupBy(*dimensions)
    if measures:
        result = grouped.agg(*[_measure(spec, m, approximate).alias(m) for m in measures])
    else:
        result = table.select(*dimensions).distinct()
    if order_by:
        ties = [d for d in dimensions if d not in {o.removeprefix("-") for o in order_by}]
        return ordered(result, [*order_by, *ties], limit)
    return result if limit is None else result.limit(limit)


def _measure(spec: Model, name: str, approximate: bool) -> Column:
    measure = spec.measures[name]
    if approximate and isinstance(measure, Distinct):
        return measure.approximate()
    return measure()


# ---------------------------------------------------------------------------
# Rollups
# ---------------------------------------------------------------------------

#: Grains that whole months make up.
COARSER = ("month", "quarter", "year")


def rollup(table: DataFrame, model: str, dimensions: Sequence[str]) -> DataFrame:
    """States of all measures of a model per combination of dimensions and month.

    The month is in the time dimension. A column ``measure__part`` holds a part of a state.
    """
    spec = MODELS[model]
    if spec.time_dimension in dimensions or set(dimensions) - set(spec.dimensions):
        raise ValueError(f"dimensions of a rollup are those of {model!r} but for its time")
    month = F.trunc(spec.time_dimension, "month").alias(spec.time_dimension)
    states = {f"{name}__{part}": c for name, m in spec.measures.items() for part, c in m.states().items()}
    return table.groupBy(*dimensions, month).agg(*[c.alias(name) for name, c in states.items()])


def from_rollup(
    rolled: DataFrame,
    model: str,
    dimensions: Sequence[str] = (),
    measures: Sequence[str] = (),
    time_grain: str = "month",
) -> DataFrame:
    """What ``query`` gives for these dimensions and measures, from the stored states of months.

    ``dimensions`` may be any of the rollup's, with the time dimension or without. Distinct counts
    are estimates of sketches; all others are equal up to the order of floating-point sums.
    """
    spec = MODELS[model]
    missing = [d for d in dimensions if d not in rolled.columns]
    missing += [m for m in measures if m not in spec.measures or not any(c.startswith(f"{m}__") for c in rolled.columns)]
    if missing:
        raise ValueError(f"the rollup has no {', '.join(missing)}")
    if time_grain not in COARSER:
        raise ValueError(f"time_grain must be one of {COARSER}")
    coarse = F.trunc(spec.time_dimension, time_grain)
    of = lambda name: lambda part: F.col(f"{name}__{part}")
    merged = [
        c.alias(f"{name}__{part}") for name in measures for part, c in spec.measures[name].merged(of(name)).items()
    ]
    grouped = rolled.withColumn(spec.time_dimension, coarse).groupBy(*dimensions).agg(*merged)
    return grouped.select(*dimensions, *[spec.measures[name].result(of(name)).alias(name) for name in measures])
