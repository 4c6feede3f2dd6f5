"""Writes to tables on disk: day, range and key replacement."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill import schemas
from quotemill.operators.quality import QualityError, Rule
from quotemill.sources.manifests import ConcurrentCommit, Files
from quotemill.sources.tables import NoTable, Tables

SCHEMA = schemas.flat("ticker string, close double, date date")
D = dt.date.fromisoformat


def frame(spark, *rows):
    return spark.createDataFrame([(t, c, D(d) if d else None) for t, c, d in rows], SCHEMA)


def content(tables):
    return sorted(
        (r["ticker"], r["close"], str(r["date"]) if r["date"] else None)
        for r in tables.read("raw/t", SCHEMA).collect()
    )


@pytest.fixture
def tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.create("raw/t", SCHEMA, "date")
    tables.append(
        "raw/t",
        frame(
            spark,
            ("A", 1.0, "2024-01-01"),
            ("B", 2.0, "2024-01-02"),
            ("A", 3.0, "2024-01-03"),
            ("B", 4.0, "2024-01-04"),
            ("A", 5.0, None),
        ),
        "date",
    )
    return tables


def test_create_makes_an_empty_table_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert not tables.exists("raw/t")
    tables.create("raw/t", SCHEMA, "date")
    tables.create("raw/t", SCHEMA, "date")
    assert tables.exists("raw/t")
    assert tables.read("raw/t", SCHEMA).count() == 0


def test_replace_day(spark, tables):
    assert tables.replace_day("raw/t", frame(spark, ("C", 9.0, "2024-01-02")), "2024-01-02")
    assert content(tables) == [
        ("A", 1.0, "2024-01-01"),
        ("A", 3.0, "2024-01-03"),
        ("A", 5.0, None),
        ("B", 4.0, "2024-01-04"),
        ("C", 9.0, "2024-01-02"),
    ]


def test_replace_range_empties_uncovered_days_and_keeps_undated_rows(spark, tables):
    batch = frame(spark, ("C", 9.0, "2024-01-03"), ("C", 8.0, None), ("C", 7.0, "2024-02-01"))
    tables.replace_range("raw/t", batch, "2024-01-02", "2024-01-04")
    assert content(tables) == [
        ("A", 1.0, "2024-01-01"),
        ("A", 5.0, None),
        ("C", 7.0, "2024-02-01"),
        ("C", 8.0, None),
        ("C", 9.0, "2024-01-03"),
    ]


def test_replace_range_takes_its_bounds_from_the_batch(spark, tables):
    tables.replace_range("raw/t", frame(spark, ("C", 9.0, "2024-01-01"), ("C", 8.0, "2024-01-03")))
    assert content(tables) == [
        ("A", 5.0, None),
        ("B", 4.0, "2024-01-04"),
        ("C", 8.0, "2024-01-03"),
        ("C", 9.0, "2024-01-01"),
    ]


def test_empty_batch_changes_nothing(spark, tables):
    before = content(tables)
    assert not tables.replace_range("raw/t", frame(spark), "2024-01-01", "2024-12-31")
    assert not tables.delete_insert("raw/t", frame(spark), ["ticker", "date"], "date")
    assert content(tables) == before


def test_delete_insert_replaces_keys_only(spark, tables):
    batch = frame(spark, ("A", 30.0, "2024-01-03"), ("A", 31.0, "2024-01-03"), ("C", 40.0, "2024-01-04"))
    tables.delete_insert("raw/t", batch, ["ticker", "date"], "date")
    assert content(tables) == [
        ("A", 1.0, "2024-01-01"),
        ("A", 5.0, None),
        ("A", 30.0, "2024-01-03"),
        ("A", 31.0, "2024-01-03"),
        ("B", 2.0, "2024-01-02"),
        ("B", 4.0, "2024-01-04"),
        ("C", 40.0, "2024-01-04"),
    ]


def test_last_date(spark, tables, tmp_path):
    assert tables.last_date("raw/t", "date") == D("2024-01-04")
    tables.overwrite("raw/u", frame(spark, ("A", 1.0, "2024-01-01"), ("A", 1.0, None)))
    assert tables.last_date("raw/u", "date") == D("2024-01-01")


def test_delete_insert_needs_the_partition_in_its_keys(spark, tables):
    with pytest.raises(ValueError):
        tables.delete_insert("raw/t", frame(spark), ["ticker"], "date")


def test_delete_insert_from_the_table_itself(spark, tables):
    doubled = tables.read("raw/t", SCHEMA).filter("date >= '2024-01-03'").withColumn("close", F.col("close") * 2)
    tables.delete_insert("raw/t", doubled, ["ticker", "date"], "date")
    assert content(tables)[1:3] == [("A", 5.0, None), ("A", 6.0, "2024-01-03")]
    assert content(tables)[-1] == ("B", 8.0, "2024-01-04")


def test_delete_insert_without_partitions(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("raw/t", frame(spark, ("A", 1.0, "2024-01-01"), ("B", 2.0, "2024-01-01")))
    tables.delete_insert("raw/t", frame(spark, ("B", 3.0, "2024-01-01")), ["ticker"], None)
    assert content(tables) == [("A", 1.0, "2024-01-01"), ("B", 3.0, "2024-01-01")]


def test_undated_rows_are_kept_and_added(spark, tables):
    tables.delete_insert("raw/t", frame(spark, ("C", 1.0, None), ("B", 20.0, "2024-01-02")), ["ticker", "date"], "date")
    assert [r for r in content(tables) if r[2] is None] == [("A", 5.0, None), ("C", 1.0, None)]
    tables.replace_range("raw/t", frame(spark, ("D", 1.0, None)))
    assert [r[0] for r in content(tables) if r[2] is None] == ["A", "C", "D"]
    assert len(content(tables)) == 7


def test_a_write_that_fails_leaves_the_old_table(spark, tables, tmp_path):
    before = content(tables)
    broken = frame(spark, ("A", 1.0, "2024-01-01")).withColumn("close", F.raise_error(F.lit("broken")).cast("double"))
    for write in (
        lambda: tables.overwrite("raw/t", broken, "date"),
        lambda: tables.replace_range("raw/t", broken, "2024-01-01", "2024-01-03"),
        lambda: tables.delete_insert("raw/t", broken, ["ticker", "date"], "date"),
    ):
        with pytest.raises(Exception, match="broken"):
            write()
        assert content(tables) == before


def data_folders(tables, table="raw/t"):
    return set(tables.files.names(f"{tables.path(table)}/data"))


def writes(spark, tables):
    """Each kind of write, with what it leaves in the table."""
    batch = frame(spark, ("C", 9.0, "2024-01-03"), ("B", 20.0, "2024-01-02"))
    return {
        "range": lambda: tables.replace_range("raw/t", batch, "2024-01-01", "2024-01-03"),
        "merge": lambda: tables.delete_insert("raw/t", batch, ["ticker", "date"], "date"),
        "whole": lambda: tables.overwrite("raw/t", batch, "date"),
        "more": lambda: tables.append("raw/t", batch, "date"),
    }


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("kind", ["range", "merge", "whole", "more"])
def test_a_writer_that_stops_anywhere_leaves_the_old_or_the_new(spark, tables, monkeypatch, kind):
    """The process ends before or after any step on files: readers see one version or the other."""
    before, steps = content(tables), []
    names = ("write", "rename", "delete", "names", "exists", "read")
    real = {name: getattr(Files, name) for name in names}

    def counted(name):
        def step(self, *arguments):
            steps.append(name)
            if stop == (len(steps), "before"):
                raise Stopped(name)
            result = real[name](self, *arguments)
            if stop == (len(steps), "after"):
                raise Stopped(name)
            return result

        return step

    seen, number = set(), 0
    while True:
        number += 1
        for when in ("before", "after"):
            stop, finished = (number, when), False
            for name in names:
                monkeypatch.setattr(Files, name, counted(name))
            steps.clear()
            try:
                writes(spark, tables)[kind]()
                finished = True
            except Stopped:
                pass
            for name in names:
                monkeypatch.setattr(Files, name, real[name])
            now = content(tables)
            seen.add(tuple(map(str, now)))
            if now != before:
                if finished and len(steps) < number:
                    assert len(seen) == 2
                    tables.expire("raw/t", keep=1)
                    assert content(tables) == now
                    return
                tables.history("raw/t").drop(tables.history("raw/t").versions()[-1])
            assert content(tables) == before


def test_old_versions_can_be_read(spark, tables):
    first = content(tables)
    at = tables.manifest("raw/t")
    tables.replace_range("raw/t", frame(spark, ("C", 9.0, "2024-01-02")), "2024-01-01", "2024-01-03")
    reading = tables.read("raw/t", SCHEMA)
    second = content(tables)
    tables.overwrite("raw/t", frame(spark, ("Z", 1.0, "2024-03-01")), "date")
    kept = sorted((r["ticker"], r["close"], str(r["date"]) if r["date"] else None) for r in reading.collect())
    assert kept == second != first  # a reader that has begun is not disturbed
    rows = tables.read("raw/t", SCHEMA, version=at.version).collect()
    assert sorted((r["ticker"], r["close"], str(r["date"]) if r["date"] else None) for r in rows) == first
    assert tables.read("raw/t", as_of=at.seconds).count() == len(first)
    with pytest.raises(NoTable):
        tables.read("raw/t", version=99)
    with pytest.raises(NoTable):
        tables.read("raw/t", as_of=1.0)
    assert tables.changed_days("raw/t", at.version) == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-03-01"}
    tables.expire("raw/t", keep=1)
    assert len(data_folders(tables)) == 1 and content(tables) == [("Z", 1.0, "2024-03-01")]
    assert tables.changed_days("raw/t", at.version) is None


def test_failed_writes_leave_no_files_behind(spark, tables):
    held = data_folders(tables)
    broken = frame(spark, ("A", 1.0, "2024-01-01")).withColumn("close", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_day("raw/t", broken, "2024-01-01")
    assert data_folders(tables) == held


def test_a_second_writer_is_refused(spark, tables, monkeypatch):
    before = content(tables)
    real = Tables._current

    def late(self, *arguments):
        found = real(self, *arguments)
        monkeypatch.setattr(Tables, "_current", real)
        self.append("raw/t", frame(spark, ("X", 1.0, "2024-09-09")), "date")
        return found

    monkeypatch.setattr(Tables, "_current", late)
    with pytest.raises(ConcurrentCommit):
        tables.overwrite("raw/t", frame(spark), "date")
    assert content(tables) == sorted(before + [("X", 1.0, "2024-09-09")], key=str) or len(content(tables)) == len(before) + 1


def test_rules_are_measured_while_rows_are_written(spark, tables):
    before, held = content(tables), data_folders(tables)
    rules = [Rule("close must be positive", F.col("close") <= 0), Rule("ticker must be unique", unique="ticker")]
    for rows, message in (
        ([("A", -1.0, "2024-01-02"), ("B", 1.0, "2024-01-02")], "positive: for example .*'A'"),
        ([("A", 1.0, "2024-01-02"), ("A", 2.0, "2024-01-03")], "unique: for example .*'A'"),
    ):
        for write in (
            lambda batch: tables.replace_range("raw/t", batch, rules=rules),
            lambda batch: tables.overwrite("raw/t", batch, "date", rules),
            lambda batch: tables.delete_insert("raw/t", batch, ["ticker", "date"], "date", rules),
        ):
            with pytest.raises(QualityError, match=message):
                write(frame(spark, *rows))
    assert content(tables) == before and data_folders(tables) == held
    assert tables.replace_day("raw/t", frame(spark, ("A", 1.0, "2024-01-02")), "2024-01-02", rules=rules)
    newest = list(tables.manifest("raw/t").commits.values())[-1]
    assert newest.metrics == {"rows": 1, "nulls.ticker": 0, "rule.0": 0}


def test_nulls_are_known_without_reading(spark, tables):
    assert tables.nulls("raw/t", "ticker").count() == 0
    assert "FileScan" not in tables.nulls("raw/t", "ticker")._jdf.queryExecution().executedPlan().toString()
    tables.append("raw/t", frame(spark, (None, 1.0, "2024-01-07"), ("A", 1.0, "2024-01-08")), "date")
    assert tables.nulls("raw/t", "ticker").count() == 1
    tables.replace_day("raw/t", frame(spark, ("B", 1.0, "2024-01-07")), "2024-01-07")
    assert tables.nulls("raw/t", "ticker").count() == 0


def test_dates_are_pruned(spark, tables):
    plan = tables.read("raw/t").filter("date >= '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_rows_that_stay_in_a_merge_are_not_shuffled(spark, tmp_path, monkeypatch):
    tables, plans = Tables(spark, str(tmp_path)), []
    tables.overwrite("raw/t", frame(spark, ("A", 1.0, "2024-01-01"), ("B", 2.0, "2024-01-02"), (None, 3.0, "2024-01-03")))
    write = tables._write

    def watched(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, *args)

    monkeypatch.setattr(tables, "_write", watched)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for value in (20.0, 30.0):
            batch = frame(spark, ("B", value, "2024-01-02"), (None, 4.0, "2024-01-03"))
            tables.delete_insert("raw/t", batch, ["ticker", "date"], None)
            monkeypatch.setattr("quotemill.sources.tables.BROADCAST_KEYS", 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange hashpartitioning" not in plans[1] and "Exchange hashpartitioning" in plans[3]
    kept = sorted((str(r["ticker"]), r["close"]) for r in tables.read("raw/t").collect())
    assert kept == [("A", 1.0), ("B", 30.0), ("None", 3.0), ("None", 4.0), ("None", 4.0)]


def test_a_large_batch_of_late_days_leaves_older_rows_alone(spark, tmp_path, monkeypatch):
    """Neither are its keys broadcast, nor are the rows of other days shuffled for them."""
    tables, plans = Tables(spark, str(tmp_path)), []
    old = [(t, 1.0, f"2024-01-{d:02d}") for t in ("A", "B", None) for d in range(1, 9)] + [("A", 2.0, None)]
    tables.overwrite("raw/t", frame(spark, *old))
    write = tables._write
    monkeypatch.setattr(tables, "_write", lambda rows, *args: plans.append(rows) or write(rows, *args))
    monkeypatch.setattr("quotemill.sources.tables.BROADCAST_KEYS", 1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    new = [("A", 5.0, "2024-01-07"), ("B", 6.0, "2024-01-08"), ("C", 7.0, "2024-01-09"), (None, 8.0, "2024-01-08")]
    try:
        tables.delete_insert("raw/t", frame(spark, *new), ["ticker", "date"], None)
        plan = plans[1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Broadcast" not in plan and "Exchange hashpartitioning" in plan and "Union" in plan
    rows = lambda: [(r["ticker"], r["close"], str(r["date"]) if r["date"] else None) for r in tables.read("raw/t").collect()]
    gone = {("A", "2024-01-07"), ("B", "2024-01-08")}
    expected = [row for row in old if (row[0], row[2]) not in gone] + new
    assert sorted(map(str, rows())) == sorted(map(str, expected))
    # Without a date in the whole batch nothing matches.
    tables.delete_insert("raw/t", frame(spark, ("A", 9.0, None), ("B", 9.0, None)), ["ticker", "date"], None)
    assert len(rows()) == len(expected) + 2
