"""Parquet tables of the warehouse layers, in versions, partitioned by date where written daily.

A write puts new files beside the old ones and then publishes a manifest that says which files the
table now has. That is the only step readers can see: a replaced range, its emptied days included,
a merge by keys and a whole new table each come at once or not at all. Files are never changed, so a
batch may be derived from the table it goes into, readers that have begun go on undisturbed, and
older versions can be read until they are expired. What a failed write leaves behind is no part of
any version, and goes with the next ``expire``.

Rules given to a write are measured while the rows are written; a batch that breaks one is not
published. One writer per table is assumed; a second one is noticed, and its commit refused.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.quality import QualityError, Rule, repeated_keys
from quotemill.sources.manifests import ALL, NO_DAY, Commit, Files, History, Manifest

Day = str | dt.date

#: Rows of a batch whose keys the driver and every task may hold while a table is merged.
BROADCAST_KEYS = 100_000
#: Codec of the tables' files.
CODEC = "zstd"


class NoTable(LookupError):
    """There is no such table, or no such version of it."""


class Tables:
    """Tables under one root folder: ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def history(self, table: str) -> History:
        return History(self.files, self.path(table))

    # -- reading ----------------------------------------------------------

    def exists(self, table: str) -> bool:
        return bool(self.history(table).versions())

    def manifest(self, table: str, version: int | None = None, as_of: float | None = None) -> Manifest:
        """The newest version, one by number, or the one that was the newest at a time."""
        history = self.history(table)
        if version is not None:
            found = history.read(version) if version in history.versions() else None
        else:
            found = history.newest() if as_of is None else history.as_of(as_of)
        if found is None:
            raise NoTable(f"{table} is not there" if version is as_of is None else f"{table} has no such version")
        return found

    def read(
        self, table: str, schema: T.StructType | None = None, version: int | None = None, as_of: float | None = None
    ) -> DataFrame:
        manifest = self.manifest(table, version, as_of)
        return self._rows(table, manifest, manifest.commits, schema)

    def last_date(self, table: str, column: str) -> dt.date | None:
        """Latest date in a table: from its manifest, or else read from one column."""
        manifest = self.manifest(table)
        if manifest.partition == column:
            return max(map(dt.date.fromisoformat, manifest.days()), default=None)
        return self.read(table).agg(F.max(column)).first()[0]

    def changed_days(self, table: str, version: int) -> set[str] | None:
        """Dated days whose rows are not those of an older version; None if it is not known."""
        history = self.history(table)
        if version not in history.versions():
            return None
        old, new = history.read(version).parts(), self.manifest(table).parts()
        return {day for day in old.keys() | new.keys() if old.get(day) != new.get(day)} - {NO_DAY}

    def nulls(self, table: str, column: str) -> DataFrame:
        """Rows without a value in ``column``, of the commits that were not measured to have none."""
        manifest = self.manifest(table)
        unsure = {n: c for n, c in manifest.commits.items() if c.metrics.get(f"nulls.{column}", 1) > 0}
        return self._rows(table, manifest, unsure, None).filter(F.col(column).isNull())

    def _rows(self, table: str, manifest: Manifest, commits: dict[str, Commit], schema) -> DataFrame:
        schema = schema or manifest.schema
        paths = []
        for name, commit in commits.items():
            folder = f"{self._data(table)}/commit={name}"
            if manifest.partition is None or set(commit.live) == set(commit.days):
                paths.append(folder)
            else:
                paths += [f"{folder}/{manifest.partition}={day}" for day in commit.live]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self._data(table))
        return reader.parquet(*paths).select(*schema.names)

    def _data(self, table: str) -> str:
        return f"{self.path(table)}/data"

    # -- writing ----------------------------------------------------------

    def create(self, table: str, schema: T.StructType, partition: str | None = None) -> None:
        """Make an empty table unless there is one."""
        if not self.exists(table):
            self._publish(table, Manifest(-1, partition, schema, {}))

    def append(self, table: str, rows: DataFrame, partition: str | None = None, rules: Sequence[Rule] = ()) -> None:
        name, commit = self._write(rows, table, partition, rules)
        self._publish(table, self._current(table, partition, rows).plus({name: commit}))

    def overwrite(
        self,
        table: str,
        rows: DataFrame,
        partition: str | None = None,
        rules: Sequence[Rule] = (),
        notes: dict[str, object] | None = None,
    ) -> None:
        """Replace the whole table, which ``rows`` may be derived from. ``notes`` go into its manifest."""
        name, commit = self._write(rows, table, partition, rules)
        held = self._current(table, partition, rows)
        made = Manifest(held.version, partition, rows.schema, {}, notes=notes or {})
        self._publish(table, made.plus({name: commit}))

    def replace_day(
        self,
        table: str,
        batch: DataFrame,
        day: Day,
        partition: str = "date",
        rules: Sequence[Rule] = (),
        if_empty: bool = False,
    ) -> bool:
        """Replace the rows of one day by a batch. An empty batch changes nothing, unless it is to."""
        return self.replace_range(table, batch, day, day, partition, rules, if_empty)

    def replace_range(
        self,
        table: str,
        batch: DataFrame,
        start: Day | None = None,
        end: Day | None = None,
        partition: str = "date",
        rules: Sequence[Rule] = (),
        if_empty: bool = False,
    ) -> bool:
        """Replace all rows from ``start`` to ``end`` by a batch; the batch's own range if not given.

        Days of the range without rows in the batch end up empty. Rows of the batch outside the
        range, or without a date, are added to what is there. An empty batch changes nothing, or with
        ``if_empty`` empties the range.
        """
        name, commit = self._write(batch, table, partition, rules)
        if not commit.days and not if_empty:
            return False
        dated = sorted(set(commit.days) - {NO_DAY})
        if (start is None or end is None) and dated:
            start, end = dated[0], dated[-1]
        held = self._current(table, partition, batch)
        replaced = [day for day in held.days() if start is not None and str(start) <= day <= str(end)]
        self._publish(table, held.without(replaced).plus({name: commit}))
        return True

    def delete_insert(
        self, table: str, batch: DataFrame, keys: Sequence[str], partition: str | None, rules: Sequence[Rule] = ()
    ) -> bool:
        """Replace the rows whose keys are in the batch, and add the batch.

        Only the days that the batch has are read and written. Rows with a NULL key match nothing.
        The keys of up to ``BROADCAST_KEYS`` new rows are broadcast, so the rows that stay are not
        shuffled. Beyond, only rows whose dates are among the batch's are looked up, by a join left
        to the planner; a batch of the last days leaves the older rows where they are.
        """
        if partition is not None and partition not in keys:
            raise ValueError(f"the keys must include the partition column {partition!r}")
        name, commit = self._write(batch, table, partition, rules)
        if not commit.days:
            return False
        held = self._current(table, partition, batch)
        touched = (set(commit.days) & held.parts().keys()) - {NO_DAY}
        if not touched:
            self._publish(table, held.plus({name: commit}))
            return True
        added = self._rows(table, Manifest(0, partition, batch.schema, {}), {name: commit}, None)
        there = held.without(held.parts().keys() - touched)
        gone, rows = added.select(*keys), self._rows(table, there, there.commits, None)
        if commit.metrics["rows"] <= BROADCAST_KEYS:
            left = rows.join(F.broadcast(gone), list(keys), "left_anti")
        else:
            # Days of a partitioned table are those of the batch already.
            days = [k for k in keys if partition is None and dict(gone.dtypes)[k] == dict(rows.dtypes)[k] == "date"]
            near = self._among(gone, days)
            left = rows.filter(near).join(gone, list(keys), "left_anti").unionByName(rows.filter(~near))
        rest, kept = self._write(left, table, partition)
        self._publish(table, held.without(touched).plus({name: commit, rest: kept}))
        return True

    @staticmethod
    def _among(batch: DataFrame, days: Sequence[str]) -> Column:
        """Whether each of the date columns ``days`` is within those of the batch; a NULL is not."""
        if not days:
            return F.lit(True)
        ends = batch.agg(*[end(k).alias(f"{n}.{k}") for k in days for n, end in (("low", F.min), ("high", F.max))]).first()
        within = [F.col(k).between(F.lit(ends[f"low.{k}"]), F.lit(ends[f"high.{k}"])) for k in days]
        return F.coalesce(reduce(Column.__and__, within), F.lit(False))

    def prepare(self, table: str, rows: DataFrame, partition: str | None = None, rules: Sequence[Rule] = ()) -> Commit:
        """Write and measure ``rows`` as for a commit, without publishing it: a rehearsal."""
        return self._write(rows, table, partition, rules)[1]

    def expire(self, table: str, keep: int = 1) -> None:
        """Forget all but the newest ``keep`` versions, and files that no version left has."""
        history = self.history(table)
        versions = history.versions()
        for version in versions[:-keep]:
            history.drop(version)
        used = {name for version in versions[-keep:] for name in history.read(version).commits}
        for folder in self.files.names(self._data(table)):
            if folder.removeprefix("commit=") not in used:
                self.files.delete(f"{self._data(table)}/{folder}")
        for draft in self.files.names(history.folder):
            if draft.startswith("_draft"):
                self.files.delete(f"{history.folder}/{draft}")

    def _current(self, table: str, partition: str | None, rows: DataFrame) -> Manifest:
        held = self.history(table).newest() or Manifest(-1, partition, rows.schema, {})
        if held.commits and held.partition != partition:
            raise ValueError(f"{table} is partitioned by {held.partition}, not by {partition}")
        return Manifest(held.version, partition, held.schema, held.commits)

    def _publish(self, table: str, manifest: Manifest) -> None:
        self.history(table).publish(manifest)

    def _write(self, rows: DataFrame, table: str, partition: str | None, rules: Sequence[Rule] = ()) -> tuple[str, Commit]:
        """Files of a new commit, which is no part of the table yet, and what was measured meanwhile.

        Rows are rebalanced to even files per partition (a large day is split) and sorted.
        """
        name = uuid.uuid4().hex
        folder = f"{self._data(table)}/commit={name}"
        seen = Observation(f"write-{name}")
        measures = {"rows": F.count(F.lit(1))}
        if "ticker" in rows.columns:
            measures["nulls.ticker"] = F.count_if(F.col("ticker").isNull())
        measures |= {f"rule.{i}": F.count_if(rule.broken) for i, rule in enumerate(rules) if rule.broken is not None}
        watched = rows.observe(seen, *[measure.alias(key) for key, measure in measures.items()])
        try:
            if partition is None:
                watched.write.option("compression", CODEC).parquet(folder)
            else:
                sort = [c for c in (partition, "ticker") if c in rows.columns]
                even = watched.hint("rebalance", F.col(partition)).sortWithinPartitions(*sort)
                even.write.option("compression", CODEC).partitionBy(partition).parquet(folder)
            metrics = self._measured(seen, measures, folder, rows.schema)
            days = tuple([ALL] if metrics["rows"] else [])
            if partition is not None:
                days = tuple(n.partition("=")[2] for n in self.files.names(folder) if n.startswith(f"{partition}="))
            commit = Commit(days, days, metrics)
            self._require(table, name, commit, rows.schema, partition, rules)
        except Exception:
            self.files.delete(folder)
            raise
        return name, commit

    def _measured(self, seen: Observation, measures: dict, folder: str, schema: T.StructType) -> dict[str, int]:
        """A plan that is known to be empty measures nothing; that nothing was written is made sure."""
        try:
            return {key: int(value) for key, value in seen.get.items()}
        except Py4JJavaError:
            if not self.spark.read.schema(schema).parquet(folder).isEmpty():
                raise
            return dict.fromkeys(measures, 0)

    def _require(self, table: str, name: str, commit: Commit, schema, partition: str | None, rules: Sequence[Rule]) -> None:
        """Raise if a rule is broken. Rules of single rows are known from the write; only keys that
        must not repeat are looked up in the new files."""
        for i, rule in enumerate(rules):
            if not commit.days or (rule.broken is not None and not commit.metrics[f"rule.{i}"]):
                continue
            written = self._rows(table, Manifest(0, partition, schema, {}), {name: commit}, None)
            bad = written.filter(rule.broken) if rule.broken is not None else repeated_keys(written, rule.unique)
            sample = bad.limit(1).collect()
            if sample:
                raise QualityError(f"{rule.message}: for example {sample[0].asDict()}")
