"""Mixing of sources to target weights by repetition rates.

Words are summed per source and per bucket of a hash of the document key. A source's target is its
share of the budget by weight, at most ``cap`` times its size; what is over goes to the other
sources by weight. Its repetition rate is target over size. Every document is emitted
``floor(rate)`` times, plus one Bernoulli copy whose probability is the fraction: the document's
hash, seeded, is held against the quantile at which the source's words, in order of the hash, come
to that fraction. So the copies meet the target within half a bucket of words.

All of it is DataFrame functions. The corpus is shuffled nowhere: what is shuffled are word counts,
summed before, and rates join by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Buckets of a source's hash range; a source's mix is off by half a bucket at most.
BUCKET_BITS = 10
#: Sources whose rates are broadcast; beyond, rates are joined over this many salts.
BROADCAST_SOURCES = 100_000
SALTS = 64


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code point order, null last."""

    weights: Sequence[int] = (5, 2, 1)
    budget: float = 1.5
    cap: float = 2.0
    seed: str = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A whole number below 2**52, the same for the same key and seed everywhere."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _bucket(drawn: Column) -> Column:
    return F.shiftright(drawn, 52 - BUCKET_BITS).cast("int")


def source_rates(counts: DataFrame, mix: Mix) -> DataFrame:
    """Per source its size, target, ``copies`` for all and ``cut``: the last bucket with one more.

    ``counts`` has (source, bucket, words). The windows over sources see a row per source, those
    over buckets at most ``2**BUCKET_BITS`` rows a source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(mix.weights)))
    weighed = sizes.withColumn("weight", F.get(weights, turn))
    full = weighed.withColumn("most", F.col("source_size") * F.lit(mix.cap))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * F.lit(mix.budget)
        - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = full.withColumn("level", level).withColumn("place", F.row_number().over(by_level))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    first = F.min(F.when(fits, F.struct("place", "level"))).over(everything)
    # Where no level fits, the budget is more than all sources may give: each gives its most.
    target = F.coalesce(F.least(F.col("most"), first["level"] * F.col("weight")), F.col("most"))
    targets = levels.select("source", "source_size", target.alias("target"))
    size = F.col("source_size")
    copies = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    targets = targets.withColumn("copies", copies)
    rest = F.col("target") - F.col("copies") * size

    by_bucket = Window.partitionBy("source").orderBy("bucket")
    sums = counts.withColumn("so_far", F.sum("words").over(by_bucket)).withColumnRenamed("source", "_source")
    near = sums.join(targets, sums["_source"].eqNullSafe(targets["source"]))
    off = F.abs(F.col("so_far") - rest)
    best = near.groupBy("source", "source_size", "target", "copies").agg(
        F.min(F.struct(off.alias("off"), F.col("bucket"))).alias("best")
    )
    cut = F.when(F.col("best.off") < rest, F.col("best.bucket")).otherwise(-1)
    return best.select("source", "source_size", "target", "copies", cut.alias("cut"))


def rates(
    docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source", key: str = "doc_id"
) -> DataFrame:
    """The table of ``source_rates``, evaluated once."""
    counts = docs.groupBy(
        F.col(source).alias("source"), _bucket(draw(F.col(key), mix.seed)).alias("bucket")
    ).agg(F.sum(words(F.col(text))).alias("words"))
    return stage(source_rates(stage(counts, "mix-words"), mix), "mix-rates")


def decide(
    docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source", key: str = "doc_id"
) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns, as a struct, so that no name can clash),
    ``copies`` (how often the mix takes it), ``source_size`` and ``target`` of its source.

    Null source: a source of its own, the last. Null text and text without words: size 0, so they
    move no rate, but are copied like the rest of their source. Rows that repeat a key share its
    draw; null keys share one. A source without words has target 0 and no copies. Empty table:
    empty result. Reruns agree, as all draws are hashes.
    """
    table = rates(docs, mix, text, source, key).withColumnRenamed("source", "name")
    drawn = draw(F.col(f"`{key}`"), mix.seed)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{source}`").alias("source"),
        _bucket(drawn).alias("bucket"),
    )
    on = packed["source"].eqNullSafe(table["name"])
    if table.count() <= BROADCAST_SOURCES:
        joined = packed.join(F.broadcast(table), on)
    else:
        spread = table.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = packed["source"].eqNullSafe(spread["name"])
        joined = packed.join(spread, on & (F.pmod(packed["bucket"], F.lit(SALTS)) == spread["share"]))
    copies = F.col("copies") + (F.col("bucket") <= F.col("cut")).cast("long")
    return joined.select("row", copies.alias("copies"), "source_size", "target")


def mixed(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in the same columns."""
    taken = decide(docs, mix, **columns).filter(F.col("copies") > 0)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return taken.select("row", copy.alias("copy")).select("row.*")
