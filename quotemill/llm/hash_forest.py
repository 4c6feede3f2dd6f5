"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives every vector a 32-bit hash string of random hyperplanes and keeps the strings in a
sorted array, so the vectors that share a prefix are one run of it. A query descends in every tree
to the runs of its longest prefixes, then ascends in all trees at once, one bit at a time, until
the runs together hold enough candidates. So prefixes are long where vectors are dense and short
where they are sparse. No run is cut: all members of the last prefix are scored exactly.

Nearness is the inner product. For hashing, each row gets one more component that brings all rows
of a block to the same length, and a query a zero there: the angle then orders rows as the inner
product does.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.blocks import against_blocks, best
from quotemill.llm.exact_search import _matrices

BITS = 32


@dataclass(frozen=True)
class Forest:
    """``enough``: the entries that all runs must hold before the ascent stops, as a share of a
    block's rows, but ``least`` of them. A row counts once per tree. Recall against brute force on
    the unit vectors of the test tables, 64 dimensions without much structure: 0.96."""

    trees: int = 128
    enough: float = 0.5
    least: int = 2_048
    block_rows: int = 16_384
    query_rows: int = 1_024
    seed: int = 7


def planes(dimensions: int, forest: Forest) -> np.ndarray:
    """Hyperplanes (dimensions + 1, trees * BITS), the same in every task."""
    return np.random.default_rng([forest.seed, dimensions]).standard_normal((dimensions + 1, forest.trees * BITS))


def _strings(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash strings (trees, rows), the first hyperplane in the highest bit."""
    out = []
    for part in np.array_split(vectors, max(1, len(vectors) // 1024)):
        bits = np.packbits(part @ normals > 0, axis=1)
        out.append(np.ascontiguousarray(bits).view(">u4").astype(np.uint64))
    return np.ascontiguousarray(np.concatenate(out).T)


class SortedForest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, forest: Forest):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.forest = ids[by_id], vectors[by_id], forest
        squares = (self.vectors**2).sum(1)
        rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
        self.normals = planes(vectors.shape[1], forest)
        strings = _strings(np.column_stack([self.vectors, rest]), self.normals)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)
        self.enough = max(forest.least, int(forest.enough * len(ids)))

    def runs(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query the run (from, to) that shares ``length[query]`` bits."""
        below = np.where(length > 0, np.uint64(2**BITS - 1) >> np.minimum(length, BITS - 1).astype(np.uint64), np.uint64(2**BITS - 1))
        below = np.where(length >= BITS, np.uint64(0), below)
        low, high = strings & ~below, strings | below
        first = np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.strings, low)])
        last = np.stack([np.searchsorted(s, x, "right") for s, x in zip(self.strings, high)])
        return first, last

    def search(self, queries: np.ndarray, own: np.ndarray, k: int):
        """Per query positions and scores of the ``k`` best rows found."""
        strings = _strings(np.column_stack([queries, np.zeros(len(queries))]), self.normals)
        # The longest prefix, the same in all trees, whose runs hold enough: they only grow on the
        # way up, so bisection finds where the ascent stops.
        short, long = np.zeros(len(queries), np.int64), np.full(len(queries), BITS, np.int64)
        while (short < long).any():
            middle = (short + long + 1) // 2
            first, last = self.runs(strings, middle)
            held = (last - first).sum(0) >= self.enough
            short, long = np.where(held, middle, short), np.where(held, long, middle - 1)
        first, last = self.runs(strings, short)
        for i, query in enumerate(queries):
            met = np.zeros(len(self.ids), bool)
            for tree, (a, b) in enumerate(zip(first[:, i], last[:, i])):
                met[self.order[tree, a:b]] = True
            rows = np.nonzero(met & (self.ids != own[i]))[0]
            if len(rows) < k:
                rows = np.nonzero(self.ids != own[i])[0]
            about = self.vectors[rows] @ query
            if len(rows) > 4 * k:
                # A product of matrices may round equal rows differently: keep what is as near as
                # that to the last score, and sum those again, each row in the same order.
                limit = np.partition(about, len(about) - k)[len(about) - k]
                rows = rows[about >= limit - 1e-9 * max(np.abs(about).max(), 1e-300)]
            scores = (self.vectors[rows] * query).sum(1)
            best_rows = np.lexsort((rows, -scores))[:k]
            yield rows[best_rows], scores[best_rows]


def search(queries: DataFrame, rows: DataFrame, k: int, forest: Forest = Forest()) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, vec) tables of finite vectors.

    Each query gets the ``k`` largest inner products found over the rows but those of its own id,
    ties to smaller ids; all rows where there are fewer than ``k``. Zero vectors take no part, nor
    do lengths other than the query's. A query id with several vectors asks with each, and the best
    of all count. Empty tables: no rows. Scores are computed from the vectors as given.
    """
    nonzero = F.exists("vec", lambda x: x != 0)

    def kernel(asked: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        forests = {d: SortedForest(ids, m, forest) for d, ids, m in _matrices(block)}
        for d, ids, matrix in _matrices(asked):
            if d not in forests:
                continue
            for own, (at, score) in zip(ids, forests[d].search(matrix, ids, k)):
                out[0].append(np.full(len(at), own))
                out[1].append(forests[d].ids[at])
                out[2].append(score)
        arrays = [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    found = against_blocks(
        queries.filter(nonzero),
        rows.filter(nonzero),
        kernel,
        "query_id long, vec_id long, score double",
        forest.block_rows,
        forest.query_rows,
    )
    return best(found.dropDuplicates(), k, F.col("score"), ["query_id"]).select("query_id", "rank", "vec_id", "score")
