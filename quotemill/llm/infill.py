"""Fill-in-middle texts: prefix, suffix and middle of a document in another order.

The places where a text may be cut, after each unit, are a compressed set of offsets. It is held in
containers of 65,536 offsets each: an array of the offsets, a bitmap, or runs, whichever is
smallest, with the number of offsets before each container. A cut after the first ``k`` units is
the set's ``k``-th member: a binary search finds the container, which selects within itself.

A unit is a run of ASCII letters or any other single character. Documents are formatted one by one
where they lie; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


# -- the set of boundaries ------------------------------------------------------


class ArrayContainer:
    """Offsets in ascending order, two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit an offset; ``ranks`` counts the bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        count = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(count) - count

    @property
    def nbytes(self) -> int:
        return self.words.nbytes

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.ranks, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.ranks[word])])


class RunContainer:
    """First offsets of runs of consecutive ones; ``ranks`` counts the offsets before each run."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.starts = low[first].astype(np.uint16)
        self.ranks = first

    @property
    def nbytes(self) -> int:
        return 2 * self.starts.nbytes

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.ranks, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.ranks[run])


class BoundarySet:
    """A set of offsets below 2**48, in ascending order, that can be asked for its k-th member."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        borders = np.flatnonzero(np.diff(high)) + 1
        self.keys = high[np.concatenate([[0], borders])] if len(offsets) else high
        self.containers = [smallest(part & (SPAN - 1)) for part in np.split(offsets, borders) if len(part)]
        sizes = np.diff(np.concatenate([[0], borders, [len(offsets)]]))
        self.before = np.concatenate([[0], np.cumsum(sizes)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The member with ``k`` smaller ones."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))


def smallest(low: np.ndarray):
    """The container of least size for ascending offsets below ``SPAN``."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    sizes = {ArrayContainer: 2 * len(low), BitmapContainer: SPAN // 8, RunContainer: 4 * runs}
    return min(sizes, key=sizes.get)(low)


def boundaries(codes: np.ndarray) -> BoundarySet:
    """0 and the offset after each unit of a text, given as code points."""
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    inside = letter[:-1] & letter[1:]
    after = np.flatnonzero(~inside) + 1
    ends = [after, [len(codes)]] if len(codes) else [after]
    return BoundarySet(np.concatenate([[0], *ends]).astype(np.int64))


# -- formatting -----------------------------------------------------------------


@dataclass(frozen=True)
class Infill:
    """``seed`` is hashed with the key; shares are in hundredths of the documents."""

    seed: str = "1"
    plain_from: int = 90
    spm_below: int = 20


def formatted(key: object, text: str, how: Infill) -> tuple:
    """(units, form, prefix length, middle length, output) of one document."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    cuts = boundaries(codes)
    units = len(cuts) - 1
    digest = hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= how.plain_from:
        return units, PLAIN, None, None, text
    first, second = sorted(x % (units + 1) for x in h[:2])
    start, end = cuts.select(first), cuts.select(second)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if h[3] % 100 < how.spm_below:
        return units, SPM, start, end - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units, PSM, start, end - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, how: Infill = Infill(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    Null text: as empty. Empty texts, texts that hold a mark, and the share ``plain_from`` leaves
    over stay as they are, with null lengths. Rows that share a key are cut by the same hashes; null
    keys hash as an empty key. Rows are never merged. Empty table: empty result. Other columns are
    ignored, whatever their names.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for at in range(0, table.num_rows, 256):
                part = table.slice(at, 256)
                keys, texts = part.column("key").to_pylist(), part.column("text").to_pylist()
                done = list(zip(*[formatted(k, t, how) for k, t in zip(keys, texts)]))
                columns = [pa.array(values, kind) for values, kind in zip(done, types)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], names=["key", *names])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(batches, f"key {kind}, {SCHEMA}")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    No text that is cut holds a mark, and no mark begins with the end of another, so the first
    place of each mark is the one that was put there.
    """
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    first = F.when(form == SPM, F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    head = F.split_part(body, first, F.lit(1))
    tail = F.split_part(body, first, F.lit(2))
    last, middle = F.split_part(tail, F.lit(MIDDLE), F.lit(1)), F.split_part(tail, F.lit(MIDDLE), F.lit(2))
    return (
        F.when(form == PLAIN, output)
        .when(form == SPM, F.concat(last, middle, head))
        .otherwise(F.concat(head, middle, last))
    )
