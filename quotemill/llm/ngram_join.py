"""Near-duplicate classes by an exact Jaccard join over word shingles.

Shingles are put in one order over the corpus, rarest first. Two documents that link share at least
``m`` shingles within their ``m``-prefixes: the first ``n - t + m`` of ``n`` shingles, where ``t``
is the least overlap a link needs. Every document picks the ``m`` whose estimated cost is least: a
longer prefix reads more postings, but only documents that share ``m`` of them are candidates. A
pair must share the smaller ``m`` of the two before it is verified.

What the result needs is classes, so pairs are neither expanded nor verified one by one:

1. Documents with equal shingle sets are one key.
2. Postings of up to ``SMALL`` keys count all their pairs. Longer ones tie each key to the next in
   order of size, which keeps together whatever could link there.
3. Ties form regions, and so do candidates among short postings. The sets of a region meet in one task, each moved once, and
   all their overlaps are counted there; only links that join two classes come out.
4. A region that is too large for a task is cut into blocks. First each block finds its classes,
   and neighbouring blocks compare some members of their largest ones. Then every key outside the
   region's largest class is held against all keys of the region, in blocks: some chunks of such
   keys at a time, so that no more than a few copies of the region are on disk.

The frequencies behind the order are counted over all documents in a table that grows with the text
up to ``MOST_BITS``, as in a full one all shingles look alike: prefixes would then hold passages that
many documents quote, and their ties would form one region. It only sorts and estimates: collisions
cost time, never a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.staging import drop_stage, shuffles_deleted, stage

#: Bits of a place in the frequency table, at least and at most, and bytes of text for each place.
LEAST_BITS, MOST_BITS, PLACE_BYTES = 20, 27, 48
#: Places of one slice of the table, as a power of two.
SLICE_BITS = 16
#: Frequencies are kept as levels: eight to each doubling.
LEVELS = 2.0 ** (np.arange(256) / 8) - 1
#: Entries of the table that a task holds before it hands on their counts.
HELD_PLACES = 1 << 22
#: Prefix entries of one posting partition, about.
PART_ENTRIES = 1 << 20
#: Prefix entries that a task holds before it hands them on.
HELD_ENTRIES = 1 << 19
#: Bytes of text shingled at once.
TEXT_BYTES = 1 << 20
SMALL = 8
#: Keys and shingles of one block of a region, and shingles of the small regions that share a task.
BLOCK_KEYS = 2_048
BLOCK_SHINGLES = 1 << 21
BIN_SHINGLES = 1 << 20
#: Members of a block's largest class that are held against those of the next block.
ENVOYS = 32
#: Chunks of a region's keys outside its largest class that are held against its blocks at a time.
FACING = 2
#: Edges whose components a task finds.
STAR_EDGES = 1_000_000
#: Keys whose sets are looked up by broadcast; beyond, by a shuffled join.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class Join:
    """``percent``: least similarity. Costs are in units of reading one posting: handing on one
    prefix entry, and holding one shingle of a candidate against the other's. ``chance``: how
    many unrelated documents at least are expected to share a shingle, by passages they quote."""

    words: int = 5
    percent: int = 75
    emit_cost: float = 2.0
    verify_cost: float = 0.1
    chance: float = 0.2


# ---- shingles -------------------------------------------------------------------------------

_ODD = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            both = []
            for base in (_ODD, pow(_ODD, -1, 2**64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps))
            self.up, self.down = both
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. A text of fewer words is one shingle."""
    raw = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    raw = _LOWER[raw]
    space = _SPACE[raw]
    edge = np.empty(len(raw), bool)
    edge[0], edge[1:] = True, space[:-1]
    start = np.nonzero(edge & ~space)[0]
    edge[-1], edge[:-1] = True, space[1:]
    end = np.nonzero(edge & ~space)[0]
    up, down = _POWERS.take(len(raw))
    sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up)
    before = np.where(start > 0, sums[np.maximum(start - 1, 0)], np.uint64(0))
    word = _mixed((sums[end] - before) * down[start] + (end - start).astype(np.uint64))
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.searchsorted(start, np.cumsum(sizes) - sizes)
    last = np.append(first[1:], len(start))
    factor = np.uint64(_ODD)
    rolled = word.copy()
    with np.errstate(over="ignore"):
        n = max(len(word) - words + 1, 0)
        rolled = word[:n].copy()
        for k in range(1, words):
            rolled = rolled * factor + word[k : n + k]
        rolled = _mixed(rolled)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for k in range(a, b):
                one = _mixed(np.array([one]))[0] ^ word[k]
            out.append(_mixed(np.array([one])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position, shingle set) of each text, null as empty, a bounded number of bytes at a time."""
    held, size, at = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py()
        held.append(text.encode() if text else b"")
        size += len(held[-1])
        if size >= TEXT_BYTES or i == len(column) - 1:
            yield from enumerate(shingle_sets(held, words), at)
            held, size, at = [], 0, i + 1


def _key(shingles: np.ndarray) -> int:
    """A 64-bit key of a shingle set, signed."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


# ---- passes over the texts ------------------------------------------------------------------


def table_bits(docs: DataFrame) -> int:
    """Bits of a place in the frequency table for the text of ``docs``."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(max((-(-size // PLACE_BYTES) - 1).bit_length(), LEAST_BITS), MOST_BITS)


def _share(counts: np.ndarray) -> bytes:
    """A slice of counts: how many are not zero, then the gaps before them and they, byte by byte."""
    at = np.nonzero(counts)[0]
    return _listed(at, counts[at])


def _listed(at: np.ndarray, counts: np.ndarray) -> bytes:
    """The same of the ascending places ``at`` and their counts."""
    numbers = ((np.diff(at, prepend=-1) - 1).astype("<u2"), counts.astype("<u4"))
    planes = b"".join(x.view(np.uint8).reshape(len(at), x.itemsize).T.tobytes() for x in numbers)
    return np.array([len(at)], "<u4").tobytes() + pa.compress(planes, "zstd", asbytes=True)


def _add_share(total: np.ndarray, share: bytes) -> None:
    n = int(np.frombuffer(share[:4], "<u4")[0])
    planes = np.frombuffer(pa.decompress(share[4:], 6 * n, "zstd", asbytes=True), np.uint8)
    gaps = np.ascontiguousarray(planes[: 2 * n].reshape(2, n).T).view("<u2").ravel()
    counts = np.ascontiguousarray(planes[2 * n :].reshape(4, n).T).view("<u4").ravel()
    total[np.cumsum(gaps.astype(np.int64) + 1) - 1] += counts


def _described(docs: DataFrame, bits: int, join: Join) -> DataFrame:
    """A row (id, n, key) per document, and shares of the frequency table in slices, but for empty
    ones. A task holds ``HELD_PLACES`` entries of the table, however large the table is."""
    kind = docs.schema["id"].dataType.simpleString()

    def shares(held: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        places = np.sort(np.concatenate(held))
        first = np.nonzero(np.diff(places, prepend=-1))[0]
        at, counts = places[first], np.diff(np.append(first, len(places)))
        used, ends = np.unique(at >> SLICE_BITS, return_index=True)
        parts = [
            _listed(at[a:b] & ((1 << SLICE_BITS) - 1), counts[a:b]) for a, b in zip(ends, np.append(ends[1:], len(at)))
        ]
        none = pa.nulls(len(used))
        return pa.RecordBatch.from_arrays(
            [none.cast(id_type), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(used, pa.int32()), pa.array(parts, pa.binary())],
            names=["id", "n", "key", "slice", "counts"],
        )

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        id_type = None
        for table in tables:
            ids, id_type = table.column("id"), table.column("id").type
            sizes, keys = np.zeros(len(ids), np.int64), [None] * len(ids)
            for i, shingles in _sets(table.column("text"), join.words):
                sizes[i] = len(shingles)
                if len(shingles):
                    keys[i] = _key(shingles)
                    places = (shingles >> np.uint64(64 - bits)).astype(np.int32)
                    held.append(places[np.diff(places, prepend=-1) > 0])
                    size += len(held[-1])
                    if size >= HELD_PLACES:
                        yield shares(held, id_type)
                        held, size = [], 0
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes), pa.array(keys, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                names=["id", "n", "key", "slice", "counts"],
            )
        if held:
            yield shares(held, id_type)

    return docs.mapInArrow(batches, f"id {kind}, n long, key long, slice int, counts binary")


def _frequencies(described: DataFrame, bits: int) -> np.ndarray:
    """The summed frequency table, as levels: at most ``2**MOST_BITS`` bytes, whatever the data. The
    driver gets it compressed."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << SLICE_BITS, np.int64)
        for v in table["counts"]:
            _add_share(total, v.as_py())
        levels = np.minimum(np.rint(8 * np.log2(total + 1.0)), len(LEVELS) - 1).astype(np.uint8)
        packed = pa.compress(levels.tobytes(), "zstd", asbytes=True)
        return pa.table({"slice": table["slice"][:1], "levels": pa.array([packed], pa.binary())})

    with shuffles_deleted(described.sparkSession):
        shares = described.filter(F.col("slice").isNotNull()).select("slice", "counts")
        rows = shares.groupBy("slice").applyInArrow(add, "slice int, levels binary").collect()
    levels = np.zeros((1 << (bits - SLICE_BITS), 1 << SLICE_BITS), np.uint8)
    for row in rows:
        levels[row["slice"]] = np.frombuffer(pa.decompress(row["levels"], 1 << SLICE_BITS, "zstd"), np.uint8)
    return levels.ravel()


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any set it links to, at least."""
    return -(-n * percent // 100)


def matches_and_prefix(frequency: np.ndarray, load: float, join: Join) -> tuple[int, int]:
    """(m, length of the m-prefix) of least estimated cost; ``frequency`` in ascending order.

    ``load`` is what an unrelated shingle finds in the table, which is taken off. At most ``read / m``
    documents can share ``m`` of the postings read.
    """
    n = len(frequency)
    least = least_overlap(n, join.percent)
    m = np.unique(np.minimum(np.maximum(1, np.round(1.3 ** np.arange(40))), max(least // 3, 1))).astype(np.int64)
    length = n - least + m
    read = np.cumsum(np.maximum(frequency - 1 - load, join.chance))[length - 1]
    cost = read + join.emit_cost * length + join.verify_cost * n * read / m
    best = int(np.argmin(cost))
    return int(m[best]), int(length[best])


def _postings(docs: DataFrame, table: np.ndarray, parts: int, join: Join) -> DataFrame:
    """Prefixes of the distinct sets of each task, as arrays per posting partition."""
    bits = len(table).bit_length() - 1
    slices = range(0, len(table), 1 << SLICE_BITS)  # counting widens what it counts
    often = sum(np.bincount(table[a : a + (1 << SLICE_BITS)], minlength=len(LEVELS)) for a in slices)
    mean = often @ LEVELS / len(table)
    shared = docs.sparkSession.sparkContext.broadcast((table, mean + 3 * mean**0.5))

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, load = shared.value
        seen: set[int] = set()
        keys, sizes, needs, prefixes = [], [], [], []
        held = 0

        def hand_on() -> pa.RecordBatch:
            token = np.concatenate(prefixes)
            owner = np.repeat(np.arange(len(keys)), [len(p) for p in prefixes])
            part = ((token >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            token, owner, part = token[order], owner[order], part[order]
            used, first = np.unique(part, return_index=True)
            rows: list[list] = [[], [], [], [], [], []]
            info = [np.array(x, kind) for x, kind in ((keys, "<i8"), (sizes, "<u4"), (needs, "<u4"))]
            for p, a, b in zip(used, first, np.append(first[1:], len(part))):
                here, local = np.unique(owner[a:b], return_inverse=True)
                for column, value in zip(rows, (p, *(x[here].tobytes() for x in info))):
                    column.append(value)
                rows[4].append(token[a:b].astype("<u8").tobytes())
                rows[5].append(local.astype("<u4").tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])],
                names=["part", "keys", "sizes", "needs", "tokens", "owners"],
            )

        for batch in tables:
            for _, shingles in _sets(batch.column("text"), join.words):
                if not len(shingles) or (key := _key(shingles)) in seen:
                    continue
                seen.add(key)
                level = levels[(shingles >> np.uint64(64 - bits)).view(np.int64)]
                order = np.argsort(level, kind="stable")
                m, length = matches_and_prefix(LEVELS[level[order]], load, join)
                keys.append(key)
                sizes.append(len(shingles))
                needs.append(m)
                prefixes.append(shingles[order[:length]])
                held += length
                if held >= HELD_ENTRIES:
                    yield hand_on()
                    keys, sizes, needs, prefixes = [], [], [], []
                    held = 0
        if keys:
            yield hand_on()

    schema = "part int, keys binary, sizes binary, needs binary, tokens binary, owners binary"
    return docs.select("text").mapInArrow(batches, schema)


def _sized(n: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])


def _matched(table: pa.Table, join: Join) -> pa.Table:
    """Pairs (a, b, matches, need) of one posting partition. Ties of long postings have need 0."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(v.as_py() for v in table[name]), kind)

    keys, sizes, needs = joined("keys", "<i8"), *(joined(c, "<u4").astype(np.int64) for c in ("sizes", "needs"))
    token, owner = joined("tokens", "<u8"), joined("owners", "<u4").astype(np.int64)
    held = np.array([len(v.as_py()) // 8 for v in table["keys"]], np.int64)
    entries = np.array([len(v.as_py()) // 8 for v in table["tokens"]], np.int64)
    owner = owner + np.repeat(np.cumsum(held) - held, entries)
    key, first, same = np.unique(keys, return_index=True, return_inverse=True)
    size, need, owner = sizes[first], needs[first], same[owner]
    # Within a posting keys go by size, so that neighbours are most alike.
    order = np.lexsort((owner, size[owner], token))
    token, owner = token[order], owner[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[fresh], owner[fresh]
    starts = np.nonzero(np.append(True, token[1:] != token[:-1]))[0] if len(token) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(token)))
    n = np.int64(len(key))
    parts = []

    def count(pairs: list[np.ndarray], tie: bool) -> None:
        pair, often = np.unique(np.concatenate(pairs), return_counts=True)
        a, b = pair // n, pair % n
        parts.append((key[a], key[b], often, np.minimum(need[a], need[b]) * (not tie)))

    def paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        fit = _sized(size, x, y, join.percent)
        x, y = x[fit], y[fit]
        return np.minimum(x, y) * n + np.maximum(x, y)

    small = []
    for m in range(2, SMALL + 1):
        at = starts[lengths == m]
        for i in range(m if len(at) else 0):
            for j in range(i + 1, m):
                small.append(paired(owner[at + i], owner[at + j]))
    if small:
        count(small, tie=False)
    in_long = np.repeat(lengths > SMALL, lengths)
    long_token, long_owner = token[in_long], owner[in_long]
    if len(long_token):
        next_to = np.nonzero(long_token[1:] == long_token[:-1])[0]
        count([paired(long_owner[next_to], long_owner[next_to + 1])], tie=True)
    names = ("a", "b", "matches", "need")
    if not parts:
        parts = [tuple(np.zeros(0, np.int64) for _ in names)]
    return pa.table({c: pa.array(np.concatenate(x), pa.int64()) for c, x in zip(names, zip(*parts))})


# ---- verification and classes ---------------------------------------------------------------


def _shingled(docs: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """``wanted`` (key, id and more) without the id, with the shingles of each key's text."""
    kind = docs.schema["id"].dataType.simpleString()

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            ids, at, keys, sets = table.column("id"), [], [], []

            def made():
                return pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at, pa.int64())), pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                    names=["id", "key", "shingles"],
                )

            for i, shingles in _sets(table.column("text"), join.words):
                if len(shingles):
                    at.append(i)
                    keys.append(_key(shingles))
                    sets.append(shingles.view(np.int64))
                if len(at) == 512:
                    yield made()
                    at, keys, sets = [], [], []
            if at:
                yield made()

    sets = docs.mapInArrow(batches, f"id {kind}, key long, shingles array<long>")
    wanted = wanted.withColumnsRenamed({"key": "k", "id": "i"})
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    found = sets.join(wanted, (sets["key"] == wanted["k"]) & sets["id"].eqNullSafe(wanted["i"]))
    return found.drop("id", "k", "i")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    flat = np.concatenate([*left, *right])
    _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    shared = np.nonzero(often > 1)[0]
    dense = np.full(len(often), -1)
    dense[shared] = np.arange(len(shared))
    code = dense[code]
    owner, code = owner[code >= 0], code[code >= 0]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    counts = np.zeros((len(left), len(right)), np.float32)
    step = 2048
    edges = np.searchsorted(code, np.arange(0, len(shared) + step, step))
    for at, (a, b) in enumerate(zip(edges, edges[1:])):
        some = np.zeros((len(left) + len(right), step), np.float32)
        some[owner[a:b], code[a:b] - at * step] = 1
        counts += some[: len(left)] @ some[len(left) :].T
    return counts.astype(np.int64)


def _joining(keys, sets, other_keys, other_sets, percent: int, classes: dict):
    """Links between the two lists that join two classes; ``classes`` is a forest of parents."""

    def find(k):
        while classes.setdefault(k, k) != k:
            classes[k] = classes[classes[k]]
            k = classes[k]
        return k

    sizes, other_sizes = np.array([len(x) for x in sets]), np.array([len(x) for x in other_sets])
    if len(sets) * len(other_sets) <= 64:
        common = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in other_sets] for x in sets])
    else:
        common = _overlaps(sets, other_sets)
    union = sizes[:, None] + other_sizes[None, :] - common
    for i, j in zip(*np.nonzero(common * 100 >= union * percent)):
        a, b = find(keys[i]), find(other_keys[j])
        if a != b:
            classes[max(a, b)] = min(a, b)
            yield keys[i], other_keys[j]


def _units(table: pa.Table, by: str):
    """(keys, sets) of each value of ``by``."""
    table = table.combine_chunks()
    unit = table[by].to_numpy()
    order = np.argsort(unit, kind="stable")
    keys, lists = table["key"].to_numpy(), table["shingles"]
    for rows in np.split(order, np.nonzero(np.diff(unit[order]))[0] + 1):
        if len(rows):
            yield int(unit[rows[0]]), keys[rows].tolist(), [lists[int(i)].values.to_numpy() for i in rows]


def _out(links) -> pa.Table:
    links = list(links)
    return pa.table({c: pa.array([x[i] for x in links], pa.int64()) for i, c in enumerate("ab")})


def _blocks(shingles: Column) -> Column:
    """Blocks for a group of keys that have so many shingles."""
    return F.ceil(F.greatest(shingles / F.lit(BLOCK_SHINGLES), F.count("*") / F.lit(BLOCK_KEYS)))


def _within(sets: DataFrame, bins: int, join: Join) -> DataFrame:
    """Links that join classes among the sets of each (region, block)."""

    def kernel(table: pa.Table) -> pa.Table:
        return _out(
            link
            for _, keys, mine in _units(table, "unit")
            if len(keys) > 1
            for link in _joining(keys, mine, keys, mine, join.percent, {})
        )

    unit = F.xxhash64("region", "block")
    dealt = sets.select("key", "shingles", unit.alias("unit"), F.pmod(unit, F.lit(bins)).alias("bin"))
    return dealt.groupBy("bin").applyInArrow(kernel, "a long, b long")


def _against(outside: DataFrame, sets: DataFrame, join: Join) -> list[DataFrame]:
    """Links between ``outside`` and ``sets`` of the same region, block by block, staged.

    A chunk of ``outside`` meets every block of its region, so all pairs at once would be on disk as
    often as there are chunks. ``FACING`` chunks of each region go at a time, and what they moved is
    deleted before the next ones.
    """

    def kernel(few: pa.Table, many: pa.Table) -> pa.Table:
        if not few.num_rows or not many.num_rows:
            return _out([])
        (_, keys, mine), (_, others, theirs) = next(_units(few, "region")), next(_units(many, "region"))
        return _out(_joining(keys, mine, others, theirs, join.percent, {}))

    blocks = stage(sets.select("region", F.col("block").alias("facing")).distinct(), "facing")
    counted = stage(outside.groupBy("region").agg(_blocks(F.sum(F.size("shingles"))).alias("chunks")), "chunks")
    place = F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk")
    found = []
    for first in range(0, counted.agg(F.max("chunks")).first()[0] or 0, FACING):
        some = F.col("chunk").between(first, first + FACING - 1)
        asked = outside.join(counted, "region").select("region", place, "key", "shingles").filter(some).join(blocks, "region")
        numbers = F.sequence(F.lit(first).cast("long"), F.least(F.lit(first + FACING), "chunks") - 1)
        chunks = counted.filter(F.col("chunks") > first).select("region", F.explode(numbers).alias("chunk"))
        held = sets.select("region", F.col("block").alias("facing"), "key", "shingles").join(chunks, "region")
        columns = ["region", "chunk", "facing"]
        pairs = asked.groupBy(*columns).cogroup(held.groupBy(*columns))
        found.append(stage(pairs.applyInArrow(lambda q, r: kernel(q, r), "a long, b long"), "links"))
    drop_stage(blocks, counted)
    return found


def _region_links(sets: DataFrame, bins: int, join: Join) -> DataFrame:
    """Links that complete the classes of all regions. ``sets`` is staged and has (region, block,
    blocks, key, shingles)."""
    links = stage(_within(sets, bins, join), "links")
    large = sets.filter("blocks > 1")
    if large.isEmpty():
        return links
    keys = large.select("region", "block", "blocks", "key")

    def labelled(found: DataFrame) -> DataFrame:
        """The class of each (region, key); a key may be in a region of ties and in one of pairs."""
        roots = connected(found)
        labels = keys.join(roots, "key", "left").withColumn("class", F.coalesce("root", "key")).drop("root")
        labels = stage(labels, "labels")
        drop_stage(roots)
        return labels

    of_block = labelled(links)
    sizes = of_block.groupBy("region", "block", "class").agg(F.count("*").alias("n"))
    first = sizes.groupBy("region", "block").agg(F.max_by("class", F.struct("n", "class")).alias("class"))
    members = of_block.join(first, ["region", "block", "class"])
    some = Window.partitionBy("region", "block").orderBy(F.xxhash64("key"), "key")
    envoys = members.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= ENVOYS)
    both = F.explode(F.array(F.col("block"), F.pmod(F.col("block") + 1, F.col("blocks"))))
    envoys = envoys.select("region", "key", both.alias("meet")).join(sets, ["region", "key"])
    meeting = envoys.select("region", F.col("meet").alias("block"), "key", "shingles")
    more = stage(links.unionByName(_within(meeting, bins, join)), "links")
    drop_stage(links, of_block)

    whole = labelled(more)
    most = whole.groupBy("region", "class").agg(F.count("*").alias("n"))
    most = most.groupBy("region").agg(F.max_by("class", F.struct("n", "class")).alias("most"))
    outside = whole.join(most, "region").filter("class <> most").select("region", "key")
    outside = stage(large.join(outside, ["region", "key"], "left_semi"), "outside", "uncompressed")
    facing = _against(outside, large, join)
    done = stage(reduce(DataFrame.unionByName, facing, more), "links")
    drop_stage(more, whole, outside, *facing)
    return done


def _star_forest(table: pa.Table) -> pa.Table:
    """The components of some edges (u, v) as stars: an edge from every other key to the smallest."""
    u, v = (table[c].to_numpy() for c in "uv")
    keys, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    left, right = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(keys))
    while True:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            break
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while len(np.nonzero(root[root] != root)[0]):
            root = root[root]
    other = np.nonzero(root != np.arange(len(keys)))[0]
    return pa.table({"u": pa.array(keys[other], pa.int64()), "v": pa.array(keys[root[other]], pa.int64())})


def connected(links: DataFrame) -> DataFrame:
    """(key, root) of all keys in ``links`` (a, b): the root is the smallest key reachable.

    Parts of at most about ``STAR_EDGES`` edges become stars first, a part a task. One part is all;
    of several, large and small stars follow in turn: every key tells its larger, then its smaller
    neighbours the smallest key it knows, until nothing changes. Minima are aggregates, so no key's
    neighbours are gathered; each round is written down.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = stage(links.filter("a <> b").select(b.alias("u"), a.alias("v")).distinct(), "edges")
    parts = edges.count() // STAR_EDGES + 1
    place = F.pmod(F.xxhash64("u", "v"), F.lit(parts))
    forests = stage(edges.groupBy(place).applyInArrow(_star_forest, "u long, v long"), "edges")
    drop_stage(edges)
    edges = _starred(forests) if parts > 1 else forests
    roots = edges.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("root"))
    itself = edges.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct()
    return roots.unionByName(itself)


def _starred(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, as stars around the smallest key of each component."""
    edges = stage(edges.distinct(), "edges")

    def mark(e: DataFrame):
        return tuple(e.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(edges)
    while state[0]:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = star.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        before, edges = edges, stage(small, "edges")
        drop_stage(before)
        after = mark(edges)
        if after == state:
            break
        state = after
    return edges


def classes(docs: DataFrame, join: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``.

    ``component_id`` is the smallest key reachable over links, itself included. Null texts and
    texts without words have no shingles and link with nothing: their class is their own key. Rows
    that repeat a text share a class. A null key is smaller than none: a class of null keys only
    has a null id. Empty table: empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    bits = table_bits(rows)
    described = stage(_described(rows, bits, join), "shingle-sizes", "zstd")
    known = described.filter(F.col("slice").isNull()).select("id", "n", "key")
    frequencies = _frequencies(described, bits)
    entries = known.agg(F.sum("n")).first()[0] or 0
    parts = max(1, int(entries * (100 - join.percent) / 100) // PART_ENTRIES + 1)
    postings = _postings(rows, frequencies, parts, join)
    schema = "a long, b long, matches long, need long"
    matched = stage(postings.groupBy("part").applyInArrow(lambda t: _matched(t, join), schema), "matched")
    counted = matched.filter("need > 0").groupBy("a", "b")
    pairs = counted.agg(F.sum("matches").alias("matches"), F.min("need").alias("need")).filter("matches >= need")
    # A pair that shares a long posting is in one region of ties, whatever else it shares; any
    # other pair has all its matches in short ones. So ties and pairs need no common regions.
    ties = connected(matched.filter("need = 0").select("a", "b").distinct())
    met = connected(pairs.select("a", "b"))
    regions = ties.select("key", F.xxhash64(F.lit("ties"), "root").alias("region")).unionByName(
        met.select("key", F.xxhash64(F.lit("pairs"), "root").alias("region"))
    )

    of_key = known.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    placed = stage(regions.join(of_key, "key"), "regions")
    drop_stage(matched, ties, met)
    sizes = placed.groupBy("region").agg(_blocks(F.sum("n")).alias("blocks"))
    wanted = placed.join(sizes, "region").select(
        "key", "id", "region", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block")
    )
    wanted = stage(wanted, "wanted")
    sets = stage(_shingled(rows, wanted, join), "sets", "uncompressed")
    bins = max(1, (placed.agg(F.sum("n")).first()[0] or 0) // BIN_SHINGLES + 1)
    drop_stage(placed, wanted)
    links = _region_links(sets, bins, join)
    roots = connected(links)
    drop_stage(sets, links)

    members = stage(
        known.join(roots, "key", "left").select("id", "n", F.coalesce("root", "key").alias("class")), "members"
    )
    drop_stage(described, roots)
    lowest = members.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("component"))
    result = members.join(lowest, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
    return result.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
