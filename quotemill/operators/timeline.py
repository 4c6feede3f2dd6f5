"""Row windows over one ticker's history, with a second form for histories that are too long.

A daily bar table holds at most one row per ticker and day, so a ticker's history is short (some
16,000 sessions in sixty years) however large the raw data behind it is: :func:`open_timeline`
then gives a plain window per ticker, one shuffle and one sort.

Where that bound does not hold, ``split`` cuts each history into blocks of a fixed row count. A
block also receives copies of the ``lookback`` rows before it, so row-based lags and frames find
the same rows as in the whole history, and frames that reach back to the first row are completed
from a small per-block summary. No task then holds more than one block of any ticker.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

NO_DATE = "9999-12-31"  # rows without a date sort last and form their own piece

# Parts of a history are told apart by one struct column. With two columns, a join or window
# could settle for rows partitioned by the key alone, and a long history would be in one task
# after all. Structs also compare NULL fields as equal.
PART = "_part"


@dataclass(frozen=True)
class Split:
    """How to cut long histories: rows per block, and the calendar pieces counted first."""

    rows_per_block: int = 65_536
    piece: str = "month"


@dataclass
class Timeline:
    rows: DataFrame
    window: WindowSpec
    keys: list[str]
    carried: bool = False  # rows may continue a history: see ``_continues``
    copies: bool = False  # rows include copies of earlier rows: see ``_own``
    helpers: tuple[str, ...] = ()
    key: str = "ticker"
    rows_per_block: int | None = None

    @property
    def history(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def frame(self, rows: int) -> WindowSpec:
        """The last ``rows`` rows, the current one included."""
        return self.window.rowsBetween(1 - rows, Window.currentRow)

    def lag(self, column: str | Column, rows: int = 1) -> Column:
        return F.lag(column, rows).over(self.window)

    def first(self, column: str) -> Column:
        """Value in the ticker's first row, NULL included."""
        seen = F.first(column).over(self.history)
        if not self.carried:
            return seen
        return F.when(F.col("_continues"), F.col(f"_first_{column}")).otherwise(seen)

    def running_max(self, column: str) -> Column:
        seen = F.max(column).over(self.history)
        return F.greatest(seen, F.col(f"_max_{column}")) if self.carried else seen

    def place(self) -> Column:
        """The row's number in its whole history, from 1."""
        return F.col("_row") + 1 if self.copies else F.row_number().over(self.window)

    def close(self, df: DataFrame) -> DataFrame:
        """Drop the copied rows and the helper columns."""
        own = df.filter("_own") if self.copies else df
        return own.drop(*self.helpers)


def open_timeline(
    df: DataFrame,
    lookback: int,
    first: Sequence[str] = (),
    running_max: Sequence[str] = (),
    key: str = "ticker",
    order: Sequence[str] = ("date",),
    split: Split | None = None,
    earlier: DataFrame | None = None,
) -> Timeline:
    """Window over ``key`` in ``order``.

    ``lookback`` is the largest number of earlier rows any expression reads, apart from the
    ``first`` and ``running_max`` columns, which may reach back to the first row. In a split the
    ``order`` columns must order the rows of a key completely.

    ``earlier`` holds older rows of the same histories, at least those beyond ``lookback``. They
    only enter the ``first`` and ``running_max`` columns, through one aggregate per key.
    """
    sort = [F.col(c).asc_nulls_last() for c in order]
    carried = tuple(f"_first_{c}" for c in first) + tuple(f"_max_{c}" for c in running_max)
    if split is not None:
        if lookback > split.rows_per_block:
            raise ValueError(f"rows_per_block must be at least the lookback of {lookback} rows")
        line = _open_split(df, lookback, first, running_max, key, order[0], sort, split, carried)
        return _continued(line, earlier, key, order, first, running_max) if earlier is not None and carried else line

    window = Window.partitionBy(key).orderBy(*sort)
    if earlier is None or not carried:
        return Timeline(df, window, [key], key=key)
    return _continued(Timeline(df, window, [key], key=key), earlier, key, order, first, running_max)


def _continued(line: Timeline, earlier: DataFrame, key: str, order, first, running_max) -> Timeline:
    """``line`` with what the older rows of each history hold for ``first`` and ``running_max``.

    The older rows are one aggregate per key. In a split, a block also has what the blocks before
    it hold, which counts where there is nothing older.
    """
    # A single plain column to order by keeps this a hash aggregate, which needs no sort.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    older = earlier.groupBy(key).agg(
        F.lit(True).alias("_older"),
        *[F.min_by(c, place).alias(f"_older_first_{c}") for c in first],
        *[F.max(c).alias(f"_older_max_{c}") for c in running_max],
    )
    older = older.withColumnRenamed(key, "_older_key")
    rows = line.rows.join(older, F.col(key).eqNullSafe(F.col("_older_key")), "left").drop("_older_key")
    known = F.coalesce("_older", F.lit(False))
    own = {c: F.col(c) if line.carried else F.lit(None) for c in [f"_first_{c}" for c in first] + [f"_max_{c}" for c in running_max]}
    columns = {f"_first_{c}": F.when(known, F.col(f"_older_first_{c}")).otherwise(own[f"_first_{c}"]) for c in first}
    columns |= {f"_max_{c}": F.greatest(F.col(f"_older_max_{c}"), own[f"_max_{c}"]) for c in running_max}
    columns["_continues"] = known | F.col("_continues") if line.carried else known
    rows = rows.withColumns(columns).drop(*[c for c in older.columns if c != "_older_key"])
    helpers = tuple(dict.fromkeys((*line.helpers, "_continues", *own)))
    return replace(line, rows=rows, carried=True, helpers=helpers)


def _open_split(df, lookback, first, running_max, key, time, sort, split, carried) -> Timeline:
    numbered = _global_row_numbers(df, key, time, sort, split.piece)
    size = F.lit(split.rows_per_block)
    numbered = numbered.withColumn("_block", F.floor(F.col("_row") / size))

    # Rows near the end of a block are copied into the next one as its history.
    here = F.struct(F.col("_block").alias("_block"), F.lit(True).alias("_own"))
    following = F.struct((F.col("_block") + 1).alias("_block"), F.lit(False).alias("_own"))
    near_end = F.col("_row") % size >= size - lookback
    places = F.when(near_end, F.array(here, following)).otherwise(F.array(here))
    placed = (
        numbered.withColumn("_place", F.explode(places))
        .select(*df.columns, "_row", "_place._block", "_place._own")
        .withColumn("_continues", F.col("_block") > 0)
        .withColumn(PART, F.struct(key, "_block"))
    )
    if carried:
        placed = placed.join(_block_summary(numbered, key, first, running_max), PART, "left")
    return Timeline(
        placed,
        Window.partitionBy(PART).orderBy("_row"),
        [PART],
        carried=bool(carried),
        copies=True,
        helpers=(PART, "_row", "_block", "_own", "_continues", *carried),
        key=key,
        rows_per_block=split.rows_per_block,
    )


def _global_row_numbers(df: DataFrame, key: str, time: str, sort: list[Column], piece: str) -> DataFrame:
    """Row number of every row in its key's history, without sorting a whole history in one task.

    Rows are numbered inside calendar pieces; the rows in earlier pieces come from counts.
    """
    pieces = df.withColumn(
        "_piece", F.coalesce(F.date_trunc(piece, F.col(time)).cast("date"), F.lit(NO_DATE).cast("date"))
    ).withColumn(PART, F.struct(key, "_piece"))
    so_far = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        pieces.groupBy(key, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(F.struct(key, "_piece").alias(PART), F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(PART).orderBy(*sort)
    return (
        pieces.join(before, PART, "left")
        .withColumn("_row", F.col("_before") + F.row_number().over(inside) - 1)
        .drop(PART, "_piece", "_before")
    )


def _block_summary(numbered: DataFrame, key: str, first: Sequence[str], running_max: Sequence[str]) -> DataFrame:
    """Per block: the first value of the history and the maximum before the block."""
    blocks = numbered.groupBy(key, "_block").agg(
        *[F.max(F.when(F.col("_row") == 0, F.col(c))).alias(f"_first_{c}") for c in first],
        *[F.max(c).alias(f"_max_{c}") for c in running_max],
    )
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        F.struct(key, "_block").alias(PART),
        *[F.max(f"_first_{c}").over(earlier).alias(f"_first_{c}") for c in first],
        *[F.max(f"_max_{c}").over(earlier).alias(f"_max_{c}") for c in running_max],
    )
