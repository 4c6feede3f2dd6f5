"""Checks that return the violating rows; a check passes when there are none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A check found violating rows."""


@dataclass(frozen=True)
class Rule:
    """A check that a write makes of its own rows: ``broken`` says of a row whether it breaks the
    rule; or ``unique`` names a key that must not repeat."""

    message: str
    broken: Column | None = None
    unique: str | None = None


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count. NULL keys are not compared."""
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def score_out_of_range(
    df: DataFrame, score: str, keys: tuple[str, ...] = ("ticker", "date"), low: int = 0, high: int = 100
) -> DataFrame:
    value = F.col(score)
    return df.filter((value < low) | (value > high) | value.isNull()).select(*keys, score)


def require_empty(violations: DataFrame, rule: str) -> None:
    """Raise when there is any violating row; stops at the first one found."""
    sample = violations.limit(1).collect()
    if sample:
        raise QualityError(f"{rule}: for example {sample[0].asDict()}")
