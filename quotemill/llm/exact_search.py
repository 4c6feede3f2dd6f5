"""Exact top-k by inner product with the threshold algorithm.

The rows of a block are sorted once per dimension. A query walks the lists of its non-zero
components together, from the end where the component adds most, and scores every row it meets. No
row it has not met can score more than the sum of the components times the values last seen. It
stops as soon as the kth score exceeds that bound. The best of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.blocks import against_blocks, best, usable

BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
#: Rows read from each list before the bound is looked at for the first time; doubled each time.
FIRST_STEP = 32


class SortedLists:
    """The rows of one block, with an order per dimension. ``vectors`` are whole numbers."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # Ascending ids make the smaller id win a tie by position.
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.orders = np.argsort(self.vectors, axis=0, kind="stable")
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact: in floating point only where no sum can leave its whole numbers."""
        if self.largest * int(np.abs(query).max(initial=0)) * len(query) < 2**53:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``k`` best rows whose id is not ``own``."""
        n = len(self.ids)
        up, down = np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
        met = np.zeros(n, bool)
        kept = np.zeros(0, np.int64)
        value = np.zeros(0, np.int64)
        depth, step = 0, max(FIRST_STEP, k)
        if not len(up) and not len(down):
            depth, met[:] = n, True
            fresh = np.arange(n)
            kept, value = self._better(kept, value, fresh, query, own, k)
        while depth < n:
            to = min(depth + step, n)
            seen = np.zeros(n, bool)
            seen[self.orders[n - to : n - depth, up]] = True
            seen[self.orders[depth:to, down]] = True
            fresh = np.nonzero(seen & ~met)[0]
            met |= seen
            kept, value = self._better(kept, value, fresh, query, own, k)
            depth, step = to, step * 2
            if len(kept) == k and depth < n:
                last = self.vectors[self.orders[n - depth, up], up] * query[up]
                low = self.vectors[self.orders[depth - 1, down], down] * query[down]
                # A row not met may tie with the kth and have a smaller id: go on while it may.
                if int(value[-1]) > int(last.sum()) + int(low.sum()):
                    break
        return kept, value

    def _better(self, kept, value, fresh, query, own, k):
        fresh = fresh[self.ids[fresh] != own]
        rows = np.concatenate([kept, fresh])
        scores = np.concatenate([value, self.scores(fresh, query)])
        order = np.lexsort((rows, -scores))[:k]
        return rows[order], scores[order]


def _matrices(table: pa.Table):
    """(ids, matrix) for each length of vector in ``table``."""
    ids = table["id"].to_numpy()
    lists = table["vec"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat, starts = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
    starts = starts - (starts[0] if len(starts) else 0)
    for d in np.unique(lengths):
        where = np.nonzero(lengths == d)[0]
        yield int(d), ids[where], flat[starts[where][:, None] + np.arange(d)]


def search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, vec) tables of whole-number vectors.

    Each query gets its ``k`` highest inner products over all rows but those of its own id, ties to
    smaller ids; fewer where there are fewer rows. Only vectors of the query's length are compared.
    Empty tables: no rows. Scores are 64-bit whole numbers.
    """

    def kernel(asked: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        lists = {d: SortedLists(ids, m) for d, ids, m in _matrices(block)}
        for d, ids, matrix in _matrices(asked):
            if d not in lists:
                continue
            for own, query in zip(ids, matrix):
                at, score = lists[d].top(query, own, k)
                out[0].append(np.full(len(at), own))
                out[1].append(lists[d].ids[at])
                out[2].append(score)
        arrays = [pa.array(np.concatenate(x) if x else np.zeros(0), pa.int64()) for x in out]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    found = against_blocks(
        queries, rows, kernel, "query_id long, vec_id long, score long", BLOCK_ROWS, QUERY_ROWS
    )
    ranked = best(found.dropDuplicates(), k, F.col("score"), ["query_id"])
    return ranked.select("query_id", "rank", "vec_id", "score")


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, vec) of the usable rows, each component x turned into floor(``scale`` * x)."""
    rows = usable(df, key, vector)
    whole = F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return rows.select("id", whole.alias("vec")).dropDuplicates()
