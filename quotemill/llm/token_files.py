"""Files of token ids in a canonical Huffman code.

A folder holds two Parquet tables. ``code`` has one row: the length of each id's code word, from
which the canonical code follows. ``segments`` has rows of about ``SEGMENT_IDS`` ids: whole
documents in ascending key order, each starting at a byte, their code words one after the other,
and for every ``BLOCK_IDS`` ids of a document the bit where they begin. The blocks are decoded
independently, by table, one id of every block at a time.

``part`` and ``segment`` order the rows. A segment knows the ids before it in its part, so where a
document starts in the whole is found from one sum per part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, NumericType, StructType

from quotemill.llm import tokens
from quotemill.llm.staging import drop_stage, stage

#: Longest code word in bits; the decoding table has two to this power entries.
MAX_BITS = 18
BLOCK_IDS = 256
#: Parts whose starts are broadcast to the readers; beyond, they are joined.
BROADCAST_PARTS = 1_000_000
SEGMENT_IDS = 262_144
PART_IDS = 8_388_608


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code word lengths of at most ``limit`` bits, 0 for ids that don't occur.

    Package-merge: in each round the packages of two of the round before join the ids, by weight;
    an id's length is the number of rounds in which it is among those that pay for the code.
    """
    used = np.nonzero(counts)[0]
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 2**limit:
        raise ValueError(f"{n} ids need longer code words than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    rounds, merged = [], weights
    rounds.append(np.ones(n, bool))
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        by_weight = np.argsort(both, kind="stable")
        merged = both[by_weight]
        rounds.append(by_weight < n)
    take = 2 * n - 2
    for is_id in reversed(rounds):
        ids = int(is_id[:take].sum())
        lengths[order[:ids]] += 1
        take = 2 * (take - ids)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code word of each id: by length, then id, counting up."""
    codes = np.zeros(len(lengths), np.int64)
    code, last = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        if lengths[i]:
            code <<= int(lengths[i]) - last
            last = int(lengths[i])
            codes[i] = code
            code += 1
    return codes


def encode_ids(lists: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray):
    """(payload, checkpoints) of each list: its code words, and the first bit of every block."""
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    bits = lengths[flat]
    before = np.cumsum(bits) - bits
    first = np.cumsum(sizes) - sizes
    total = np.append(before, bits.sum())
    start_bits = total[first]
    list_bits = total[first + sizes] - start_bits
    list_bytes = -(-list_bits // 8)
    base = np.cumsum(list_bytes) - list_bytes
    at = before - np.repeat(start_bits - base * 8, sizes)
    word, shift = at >> 5, at & 31
    value = codes[flat].astype(np.uint64) << (64 - bits - shift).astype(np.uint64)
    n = int(base[-1] + list_bytes[-1]) // 4 + 3 if len(lists) else 0
    # No two code words share a bit, so sums of 32-bit halves are exact.
    high = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=n)
    low = np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    payload = (high + low).astype(np.uint64).astype(">u4").tobytes()
    out = []
    for i in range(len(lists)):
        marks = before[first[i] : first[i] + sizes[i] : BLOCK_IDS] - start_bits[i]
        out.append((payload[base[i] : base[i] + list_bytes[i]], marks))
    return out


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.limit = max(int(lengths.max(initial=0)), 1)
        codes = canonical_codes(lengths)
        used = np.nonzero(lengths)[0]
        self.ids = np.zeros(2**self.limit, np.uint32)
        self.bits = np.zeros(2**self.limit, np.int64)
        free = self.limit - lengths[used]
        by_code = np.argsort(codes[used] << free, kind="stable")
        repeat = 1 << free[by_code]
        self.ids[: repeat.sum()] = np.repeat(used[by_code], repeat)
        self.bits[: repeat.sum()] = np.repeat(lengths[used][by_code], repeat)

    def blocks(self, payload: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of all blocks, in order. Each block begins at its bit and knows no other."""
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.zeros(int(sizes.sum()), np.uint32)
        place = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        at, place = starts[order].copy(), place[order]
        alive = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(int(sizes.max(initial=0))), "right")
        mask = np.uint32(2**self.limit - 1)
        for step, n in enumerate(alive):
            now = at[:n]
            seen = window[now >> 3] >> (32 - self.limit - (now & 7)).astype(np.uint32) & mask
            out[place[:n] + step] = self.ids[seen]
            now += self.bits[seen]
        return out


class Layout:
    """Which part a row goes to, so that parts follow one another in the order of keys, nulls first.

    Borders only say how large parts are; keys are held against them as what they are, so the order
    is that of whole 64-bit numbers. A key that takes several parts, and the null key, is spread
    over them in the order of its ties.
    """

    def __init__(self, borders: np.ndarray, null_parts: int):
        self.borders, self.null_parts = borders, null_parts
        self.parts = null_parts + len(borders) + 1

    def __call__(self, keys: pa.Array, ties: np.ndarray) -> np.ndarray:
        null = keys.is_null().to_numpy(zero_copy_only=False)
        values = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(self.borders.dtype)
        low = self.null_parts + np.searchsorted(self.borders, values, "left")
        high = self.null_parts + np.searchsorted(self.borders, values, "right")
        low, high = np.where(null, 0, low), np.where(null, max(0, self.null_parts - 1), high)
        place = ties / 2.0**64 + 0.5
        return low + np.minimum((place * (high - low + 1)).astype(np.int64), high - low)


def _layout(coded: DataFrame, parts: int) -> Layout:
    """Borders at about equal numbers of rows; they are counted from the least key, so that they lie
    apart where all keys are large."""
    whole = isinstance(coded.schema["key"].dataType, IntegralType)
    if not whole and not isinstance(coded.schema["key"].dataType, NumericType):
        raise TypeError("keys of token files are numbers")
    least, nulls, rows = coded.agg(F.min("key"), F.count_if(F.col("key").isNull()), F.count(F.lit(1))).first()
    kind = np.int64 if whole else np.float64
    if least is None or parts == 1:
        return Layout(np.zeros(0, kind), 0 if least is not None or parts == 1 else parts - 1)
    null_parts = -(-parts * nulls // rows)
    dated = max(1, parts - null_parts)
    wide = "decimal(38,0)" if whole else "double"  # differences of 64-bit keys pass 64 bits
    over = coded.select((F.col("key").cast(wide) - F.lit(least).cast(wide)).cast("double").alias("over"))
    cuts = over.approxQuantile("over", [i / dated for i in range(1, dated)], 0.25 / dated) if dated > 1 else []
    top = 2**63 - 1
    borders = [min(top, int(least) + int(c)) for c in cuts] if whole else [float(least) + c for c in cuts]
    return Layout(np.array(borders, kind), null_parts)


SEGMENT = """part int, segment int, ids_before long, keys array<{key}>, sizes array<long>,
    bytes array<long>, checkpoints array<long>, payload binary"""


def write(
    docs: DataFrame, path: str, config: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of all rows of ``docs`` to the folder ``path``, in ascending ``key`` order.

    Null and empty texts: the end id alone. Null keys come first; rows that share a key are ordered
    by a hash of their text. Rows are never merged. An empty table gives files without segments.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = max(tokens.vocabulary_size(config), end_id + 1)
    kind = tokens.id_type(tokens.vocabulary_size(config))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), F.col(f"`{text}`").alias("text")
    )
    coded = stage(tokens.encode(rows, config, "text", end_id), "token-ids", "zstd")
    counts = tokens.counts(coded, vocabulary)
    lengths = code_lengths(counts, max(MAX_BITS, math.ceil(math.log2(vocabulary)) + 2))
    spark.createDataFrame([(lengths.tolist(),)], "lengths array<int>").coalesce(1).write.parquet(f"{path}/code")

    parts = max(1, -(-int(counts.sum()) // PART_IDS))
    layout = _layout(coded, parts)
    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths, layout))
    key_type = coded.schema["key"].dataType.simpleString()

    def encoded(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths, layout = shared.value
        for table in tables:
            for at in range(0, table.num_rows, 256):
                part = table.slice(at, 256)
                lists = [np.frombuffer(v.as_py(), kind) for v in part.column("ids")]
                done = encode_ids(lists, codes, lengths)
                to = layout(part.column("key"), part.column("tie").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("tie"),
                        pa.array(to, pa.int32()),
                        pa.array([len(x) for x in lists], pa.int64()),
                        pa.array([x for x, _ in done], pa.binary()),
                        pa.array([x for _, x in done], pa.list_(pa.int64())),
                    ],
                    names=["key", "tie", "part", "size", "payload", "marks"],
                )

    def segments(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        part, segment, before, held_ids = None, 0, 0, 0

        def flush() -> pa.RecordBatch:
            base = np.cumsum([0] + [len(r["payload"]) for r in held])
            marks = [m + 8 * int(b) for r, b in zip(held, base) for m in r["marks"]]
            row = {
                "part": part,
                "segment": segment,
                "ids_before": before,
                "keys": [r["key"] for r in held],
                "sizes": [r["size"] for r in held],
                "bytes": [len(r["payload"]) for r in held],
                "checkpoints": marks,
                "payload": b"".join(r["payload"] for r in held),
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for table in tables:
            for row in table.to_pylist():
                if held and (row["part"] != part or held_ids >= SEGMENT_IDS):
                    yield flush()
                    segment, before = segment + 1, before + held_ids
                    held, held_ids = [], 0
                if row["part"] != part:
                    part, segment, before = row["part"], 0, 0
                held.append(row)
                held_ids += row["size"]
        if held:
            yield flush()

    segment_schema = StructType.fromDDL(SEGMENT.format(key=key_type))
    arrow = to_arrow_schema(segment_schema)
    bits = coded.mapInArrow(
        encoded, f"key {key_type}, tie long, part int, size long, payload binary, marks array<long>"
    )
    # A partition is a part: its number is where it goes.
    ordered = bits.repartitionById(layout.parts, F.col("part")).sortWithinPartitions("part", F.col("key").asc_nulls_first(), "tie")
    ordered.mapInArrow(segments, segment_schema).write.option("compression", "zstd").parquet(f"{path}/segments")
    drop_stage(coded)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids) of each document; ``start`` counts the ids of all before it and
    ``ids`` holds its ids as little-endian unsigned 32-bit numbers."""
    stored = spark.read.parquet(f"{path}/segments")
    lengths = np.array(spark.read.parquet(f"{path}/code").first()["lengths"], np.int64)
    shared = spark.sparkContext.broadcast(lengths)
    held = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = stored.select("part", held.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("part_start"))
    if starts.count() <= BROADCAST_PARTS:
        starts = F.broadcast(starts)
    placed = stored.join(starts, "part").select(
        (F.col("part_start") + F.col("ids_before")).alias("start"), "keys", "sizes", "bytes", "checkpoints", "payload"
    )
    key_type = stored.schema["keys"].dataType.elementType.simpleString()

    def decoded(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for table in tables:
            for i in range(table.num_rows):
                sizes = table.column("sizes")[i].values.to_numpy()
                marks = table.column("checkpoints")[i].values.to_numpy()
                per_list = -(-sizes // BLOCK_IDS)
                block_sizes = np.full(int(per_list.sum()), BLOCK_IDS, np.int64)
                ends = np.cumsum(per_list)
                block_sizes[ends[per_list > 0] - 1] = (sizes - (per_list - 1) * BLOCK_IDS)[per_list > 0]
                ids = decoder.blocks(table.column("payload")[i].as_py(), marks, block_sizes).astype("<u4")
                raw = ids.tobytes()
                begin = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        table.column("keys")[i].values,
                        pa.array(begin + table.column("start")[i].as_py(), pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([raw[4 * b : 4 * (b + n)] for b, n in zip(begin, sizes)], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(decoded, f"key {key_type}, start long, n_tokens long, ids binary")
