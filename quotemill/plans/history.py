"""The stored state of closed price histories, kept beside the tables and carried on by each run.

The state of all bars before a day is the stored one merged with the bars since, so a run reads the
days that have become closed and none before them. It knows from which versions of the price tables
it was made: if a closed day was written again since, it is made anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.scalars import as_date
from quotemill.operators.state import history_state, merged
from quotemill.sources.tables import Tables

STATE_TABLE = "state/stock_prices"


def closed_before(tables: Tables, prices: DataFrame, sources: Sequence[str], day: dt.date) -> DataFrame:
    """State of the bars before ``day``; ``sources`` are the tables that ``prices`` is read from.

    Where a later day was closed already, the state covers that: first closes and peaks are the
    same for whoever reads on from ``day``.
    """
    last_closed = day - dt.timedelta(days=1)
    versions = {name: tables.manifest(name).version for name in sources}
    closed = F.col("date") < as_date(day)
    through = _through(tables, versions)
    if through is None:
        state = history_state(prices.filter(closed))
    elif through >= last_closed:
        return tables.read(STATE_TABLE)
    else:
        since = prices.filter(closed & (F.col("date") > as_date(through)))
        state = merged(tables.read(STATE_TABLE), history_state(since))
    tables.overwrite(STATE_TABLE, state, notes={"through": last_closed.isoformat(), "versions": versions})
    return tables.read(STATE_TABLE)


def _through(tables: Tables, versions: dict[str, int]) -> dt.date | None:
    """The last day that the stored state covers; None if there is none, or it is out of date."""
    if not tables.exists(STATE_TABLE):
        return None
    notes = tables.manifest(STATE_TABLE).notes
    if set(notes["versions"]) != set(versions):
        return None
    for name, version in notes["versions"].items():
        changed = tables.changed_days(name, version)
        if changed is None or any(not day[:1].isdigit() or day <= notes["through"] for day in changed):
            return None
    return dt.date.fromisoformat(notes["through"])
