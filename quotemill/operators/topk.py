"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def latest_k(
    df: DataFrame,
    k: int | None,
    newest: Sequence[Column],
    spread: Sequence[str],
    key: str = "ticker",
    salts: int = SALTS,
) -> DataFrame:
    """The first ``k`` rows of each key in the order ``newest``; all rows where ``k`` is None.

    Rows of a key are first ranked within ``salts`` shares, told apart by a hash of the
    ``spread`` columns, and the survivors are ranked again. No task sees a whole key: Spark keeps
    ``k`` rows per share before each shuffle, and the last step gets at most ``salts * k`` rows
    of a key. ``newest`` should order the rows completely, so a rerun keeps the same ones.
    """
    if k is None:
        return df
    share = F.pmod(F.xxhash64(*spread), F.lit(salts))
    shared = df.withColumn("_share", share)
    by_share = Window.partitionBy(key, "_share").orderBy(*newest)
    by_key = Window.partitionBy(key).orderBy(*newest)
    kept = shared.withColumn("_rank", F.row_number().over(by_share)).filter(F.col("_rank") <= k)
    ranked = kept.withColumn("_rank", F.row_number().over(by_key)).filter(F.col("_rank") <= k)
    return ranked.drop("_share", "_rank")
