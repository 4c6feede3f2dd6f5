"""Recursive averages along each ticker's history, which no window function can express.

A recursion takes values one after the other and carries a small state. Where a history fits a task
it is one grouped function: one shuffle and one sort. A ``Split`` cuts histories into calendar
pieces. As the recursions are affine in their state, a piece folds into a summary of fixed size that
leads from any state before the piece to the state after it; summaries compose associatively, and
the state before each piece comes from one row per piece. Then each piece is run from its state. No
task holds more than a piece, or a ticker's summaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.operators.timeline import NO_DATE, Split

State = list[float]


class Recursion(Protocol):
    """States and summaries are lists of numbers; an empty state is the one before all rows."""

    outputs: Sequence[str]

    def run(self, values: list[float], state: State) -> tuple[list[list[float | None]], State]:
        """The outputs of each value, and the state after the last."""

    def summary(self, values: list[float]) -> list[float]:
        """What ``after`` needs to know of a piece."""

    def after(self, state: State, summary: list[float]) -> State:
        """The state behind a piece, given that before it."""


class Macd:
    """Two exponential averages seeded with the first value, their difference and its average."""

    outputs = ("macd_value", "signal_value", "histogram_value")

    def __init__(self, short: int, long: int, signal: int):
        self.weights = tuple(2 / (n + 1) for n in (short, long, signal))
        a, b, c = self.weights
        self.step = np.array([[1 - a, 0, 0], [0, 1 - b, 0], [c * (1 - a), -c * (1 - b), 1 - c]])

    def run(self, values, state):
        a, b, c = self.weights
        short, long, signal = state or (values[0], values[0], 0.0)
        lines, signals, gaps = [], [], []
        for x in values:
            short += a * (x - short)
            long += b * (x - long)
            line = short - long
            signal += c * (line - signal)
            lines.append(line)
            signals.append(signal)
            gaps.append(line - signal)
        return [lines, signals, gaps], [short, long, signal]

    def summary(self, values):
        """Number of values, the first, and the state they lead to from zeros."""
        return [float(len(values)), values[0], *self.run(values, [0.0, 0.0, 0.0])[1]]

    def after(self, state, summary):
        n, first, *own = summary
        before = np.array(state or (first, first, 0.0))
        return (np.linalg.matrix_power(self.step, int(n)) @ before + own).tolist()


class WilderRsi:
    """Gains and losses smoothed from the mean of the first ``window`` changes on."""

    outputs = ("rsi_value",)

    def __init__(self, window: int):
        self.window = window

    def run(self, values, state):
        n, last, gain, loss = state or (0, 0.0, 0.0, 0.0)
        window, out = self.window, []
        for x in values:
            change = x - last if n else 0.0
            up, down = max(change, 0.0), max(-change, 0.0)
            if n <= window:
                gain, loss = gain + up, loss + down
                if n == window:
                    gain, loss = gain / window, loss / window
            else:
                gain += (up - gain) / window
                loss += (down - loss) / window
            n, last = n + 1, x
            out.append(_strength(gain, loss) if n > window else None)
        return [out], [float(n), last, gain, loss]

    def summary(self, values):
        """The values that may fall into the seed; for the rest their number, the last, and the
        smoothed gain and loss they lead to from zeros."""
        head, rest = values[: self.window + 1], values[self.window + 1 :]
        seeded = [self.window + 1.0, head[-1], 0.0, 0.0]
        _, (_, last, gain, loss) = self.run(rest, seeded)
        return [float(len(rest)), last, gain, loss, *head]

    def after(self, state, summary):
        n, last, gain, loss, *head = summary
        _, (before, _, old_gain, old_loss) = self.run(head, state)
        fade = (1 - 1 / self.window) ** n
        return [before + n, last, gain + fade * old_gain, loss + fade * old_loss]


def _strength(gain: float, loss: float) -> float:
    if loss == 0:
        return 50.0 if gain == 0 else 100.0
    return 100 - 100 / (1 + gain / loss)


def along_history(rows: DataFrame, recursion: Recursion, split: Split | None = None) -> DataFrame:
    """(ticker, date, outputs) for (ticker, date, close); closes are doubles and not null.

    Rows go by date, those without one last; rows of one day by their close.
    """
    outputs = "".join(f", {name} double" for name in recursion.outputs)
    schema = f"ticker string, date date{outputs}"

    def run(table: pa.Table, state: State) -> pa.Table:
        table = _ordered(table)
        values, _ = recursion.run(table.column("close").to_pylist(), state)
        made = [pa.array(v, pa.float64()) for v in values]
        return pa.table([table.column("ticker"), table.column("date"), *made], ["ticker", "date", *recursion.outputs])

    if split is None:
        return rows.groupBy("ticker").applyInArrow(lambda table: run(table, []), schema)

    piece = F.coalesce(F.date_trunc(split.piece, "date").cast("date"), F.lit(NO_DATE).cast("date"))
    placed = rows.withColumn("piece", piece)
    # One struct: by two columns, rows that lie by ticker alone would do, and a long history be one task.
    part = F.struct("ticker", "piece")

    def folded(table: pa.Table) -> pa.Table:
        values = _ordered(table).column("close").to_pylist()
        summary = pa.array([recursion.summary(values)], pa.list_(pa.float64()))
        return table.select(["ticker", "piece"]).slice(0, 1).append_column("summary", summary)

    def composed(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table.column("piece")))
        states, state = [], []
        for summary in table.column("summary").to_pylist():
            states.append(state)
            state = recursion.after(state, summary)
        return table.select(["ticker", "piece"]).append_column("state", pa.array(states, pa.list_(pa.float64())))

    summaries = placed.groupBy(part).applyInArrow(folded, "ticker string, piece date, summary array<double>")
    states = summaries.groupBy("ticker").applyInArrow(composed, "ticker string, piece date, state array<double>")
    pairs = placed.groupBy(part).cogroup(states.groupBy(part))
    return pairs.applyInArrow(lambda table, before: run(table, before.column("state")[0].as_py()), schema)


def _ordered(table: pa.Table) -> pa.Table:
    order = [("date", "ascending"), ("close", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_end"))
