"""Fill-in-middle: the set of boundaries, cuts by hand, exact rebuilding."""

import hashlib
import re

import numpy as np
import pytest
from docs import odd_rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotemill.llm import infill


@pytest.mark.parametrize(
    "offsets, kind",
    [
        ([3, 70, 9000], infill.ArrayContainer),
        (range(5, 60_000), infill.RunContainer),
        (range(0, 65_536, 3), infill.BitmapContainer),
    ],
)
def test_containers_select(offsets, kind):
    low = np.array(offsets, np.int64)
    container = infill.smallest(low)
    assert type(container) is kind
    assert [container.select(k) for k in range(0, len(low), 7)] == low[::7].tolist()
    assert container.nbytes == min(2 * len(low), 8192, 4 * (1 + int((np.diff(low) != 1).sum())))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 400_000), max_size=50), st.integers(0, 300_000), st.integers(0, 40_000), st.integers(1, 5))
def test_set_selects_every_member(some, start, length, step):
    offsets = np.array(sorted(some | set(range(start, start + length, step))), np.int64)
    held = infill.BoundarySet(offsets)
    assert len(held) == len(offsets)
    assert [held.select(k) for k in range(0, len(offsets), 101)] == offsets[::101].tolist()
    with pytest.raises(IndexError):
        held.select(len(offsets))


def expected(doc_id, text):
    """By units as a list of strings."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def test_every_row_against_lists_of_units(spark):
    rows = odd_rows()
    rows += [(200 + i, t, "en", "web", 0) for i, t in enumerate(["<S", "a<M>b", "<<P", "<", "a" * 70_000, "!" * 70_000, "ab! " * 40_000])]
    rows += [(300 + i, "x<y <S <M> <P".replace("<M>", "<M" * (i % 3)) * (i % 5), None, None, None) for i in range(60)]
    made = infill.transform(table(spark, rows)).withColumn("restored", infill.restored(F.col("output"), F.col("form")))
    got = sorted(map(tuple, made.collect()), key=repr)
    assert got == sorted(((r[0], *expected(r[0], r[1])) for r in rows), key=repr)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert infill.transform(table(spark, [])).count() == 0


def test_nothing_is_shuffled(spark):
    plan = infill.transform(spark.range(3).selectExpr("id AS doc_id", "'a b' AS text"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
