"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table. Shards take turns: each
claims the first slot of its permutation that nobody has. The full table gives every shard the
same number of slots, but for one, and most slots keep their shard when a shard joins or leaves.
Rows look up the slot of their key's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots. A prime, and far more than shards, so that shares differ by one slot in many.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the index of its shard. Depends on the names alone, not on their order."""
    if not _is_prime(size):
        raise ValueError("the number of slots must be prime, so that every step visits all slots")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shard names must be given, distinct and no more than slots")
    turns = []
    for name in sorted(shards):
        digest = hashlib.sha256(name.encode()).digest()
        start = int.from_bytes(digest[:8], "big") % size
        step = int.from_bytes(digest[8:16], "big") % (size - 1) + 1
        turns.append([list(shards).index(name), start, step])
    table = [-1] * size
    free = size
    while True:
        for turn in turns:
            index, slot, step = turn
            while table[slot] >= 0:
                slot = (slot + step) % size
            table[slot] = index
            turn[1] = slot
            free -= 1
            if not free:
                return table


def place(
    df: DataFrame,
    key: Sequence[str],
    shards: Sequence[str],
    size: int = TABLE_SIZE,
    slot_col: str = "slot",
    shard_col: str = "shard",
) -> DataFrame:
    """``df`` with the slot and the shard of each row's ``key`` columns.

    No shuffle: the table has ``size`` rows whatever the data, and is broadcast. Equal keys share a
    shard, by purpose; null key columns count as a value. A key that is wholly null is one key.
    Rows are neither dropped nor merged; an empty table gives an empty table. Columns named like
    the two new ones are replaced.
    """
    spark = df.sparkSession
    rows = [(slot, shards[index]) for slot, index in enumerate(lookup_table(shards, size))]
    table = spark.createDataFrame(rows, "_slot int, _shard string")
    hashed = F.pmod(F.xxhash64(*[F.struct(F.col(c)) for c in key]), F.lit(size)).cast("int")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (slot_col, shard_col)]
    placed = df.select(*kept, hashed.alias("_slot_of_row"))
    joined = placed.join(F.broadcast(table), placed["_slot_of_row"] == table["_slot"], "left")
    return joined.select(*kept, F.col("_slot_of_row").alias(slot_col), F.col("_shard").alias(shard_col))
