"""Compare a Spark result with the result of its reference SQL."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def normalized(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns differ: only one side has {set(names) ^ set(df.columns)}"
    typed = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    wrong = {n: (typed[n], kinds[n]) for n in names if typed[n] != kinds[n]}
    expected = normalized(result.fetchall(), names)
    actual = normalized([tuple(r) for r in df.collect()], df.columns)
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, sorted {sorted(names)}: {bad[0][0]} expected {bad[0][1]}"
    if wrong:
        return f"types differ: {wrong}"
    return None
