"""A stated query set against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.staging import deal


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): rows with an id and a vector of finite components, in double precision.

    Left out: a null id, a null or empty vector, one with a null or non-finite component. Rows that
    repeat both id and vector count once. Other columns are dropped.
    """
    vec = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("id").isNotNull() & (F.size("vec") > 0) & finite).dropDuplicates()


def against_blocks(
    queries: DataFrame,
    rows: DataFrame,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    block_rows: int,
    query_rows: int,
) -> DataFrame:
    """``kernel(queries, rows)`` on every pair of a chunk of queries and a block of rows.

    Chunks and blocks are dealt by a hash of id and vector, so no id, bucket or group of copies
    makes one larger; their sizes are parameters, their numbers follow the tables. A task holds
    one chunk and one block. Work is queries times rows over the block size, which is what an exact
    search, or an index per block, comes to.
    """
    blocks = max(1, -(-rows.count() // block_rows))
    chunks = max(1, -(-queries.count() // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("block", deal(["id", "vec"], blocks)).withColumn("chunk", every(chunks))
    asked = queries.withColumn("chunk", deal(["id", "vec"], chunks)).withColumn("block", every(blocks))
    pairs = asked.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk"))
    return pairs.applyInArrow(lambda q, r: kernel(q, r), schema)


def best(found: DataFrame, k: int, score: Column, by: list[str]) -> DataFrame:
    """The ``k`` highest ``score`` of each ``by``, ties to smaller ids, with ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(score.desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
