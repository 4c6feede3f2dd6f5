"""Point scales: the first step whose condition holds gives the points."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(steps: list[tuple[Column, int]], otherwise: int) -> Column:
    (condition, points), *rest = steps
    scale = F.when(condition, F.lit(points))
    for condition, points in rest:
        scale = scale.when(condition, F.lit(points))
    return scale.otherwise(F.lit(otherwise))


def exact(text: str) -> Column:
    """Decimal literal, so thresholds compare without binary rounding."""
    return F.lit(Decimal(text))


def above(column: str, steps: dict[str, int], otherwise: int) -> Column:
    return first_match([(F.col(column) > exact(t), p) for t, p in steps.items()], otherwise)


def below(column: str, steps: dict[str, int], otherwise: int) -> Column:
    return first_match([(F.col(column) < exact(t), p) for t, p in steps.items()], otherwise)
