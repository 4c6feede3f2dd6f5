"""Phrases whose words keep together, by prefix-free parsing of the corpus.

Documents are cut into chunks by their content: a chunk ends wherever the hash of the last
``longest - 1`` words hits a given remainder, and the next one begins with those same words. So
equal passages are cut alike wherever they stand, and copies of a passage are one chunk of the
dictionary with a frequency. n-grams are counted inside distinct chunks, times the frequency. Two
neighbours share ``longest - 1`` words, in which an n-gram might be met twice: it belongs to the
chunk whose shared end it does not begin in; the last chunk of a document owns all of its own.

The dictionary is read once a length. A phrase is counted only if the two phrases of one word less
in it are frequent, which a frequent phrase's always are. Which ones are is told by a table of bits,
of a size that follows their number up to a bound; beyond it more is counted than need be, and
nothing less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.staging import drop_stage, stage

NO_LANG = "und"
#: Copies of a table of counts, over which the candidates that ask for the same part are spread.
SALTS = 8
#: Bits a frequent phrase has in the table, and the logarithms of its least and largest size.
BITS_EACH, LEAST_LOG, MOST_LOG = 16, 16, 27
#: Bytes of text that are cut into words at once.
TEXT_BYTES = 2 << 20

# Classes of bytes: within a word, between words, between pieces.
_WORD, _BLANK, _BREAK = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b" \t")] = _BLANK
_CLASS[list(b".,;:!?\n\v\f\r")] = _BREAK
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the ``keep`` best a language.
    A phrase goes if a longer one has ``covered`` hundredths of its occurrences. A chunk is about
    ``chunk_words`` words long."""

    longest: int = 3
    least: int = 10
    keep: int = 2_000
    covered: int = 50
    chunk_words: int = 32


# -- words ----------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Whole numbers spread evenly over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a batch of texts: where they start and end in its bytes, the text they are of,
    whether a word begins a piece, and a hash of each."""

    def __init__(self, texts: pa.Array):
        """``texts`` holds no nulls."""
        offsets, data = _bytes(texts)
        self.data = _FOLD[data]
        kind = _CLASS[data]
        # A break closes every text, so no word runs over from one to the next.
        first = np.zeros(len(kind) + 1, bool)
        first[offsets[:-1]] = True
        word = kind == _WORD
        starts = word.copy()
        starts[1:] &= ~word[:-1] | first[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | first[1:-1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        breaks = np.concatenate([[0], np.cumsum(kind == _BREAK)])
        self.opens = np.ones(len(self.start), bool)
        parted = breaks[self.start[1:]] != breaks[self.end[:-1]]
        self.opens[1:] = parted | (self.text[1:] != self.text[:-1])
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """A polynomial of each word's bytes, from running sums, shifted to begin at power 0."""
        ahead, back = _powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * ahead, out=sums[1:])
        return _mix((sums[self.end] - sums[self.start]) * back[self.start])

    def slices(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """The bytes from ``start`` to ``end`` as strings."""
        size = end - start
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
        return pa.LargeStringArray.from_buffers(
            len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data[at]))
        )


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; a worker keeps those of usual sizes."""
    made = _POWERS
    if n > len(made[0]):
        made = []
        for base in (_BASE, _UNBASE):
            steps = np.full(max(n, TEXT_BYTES), base)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if n <= 2 * TEXT_BYTES:
            _POWERS[:] = made
    return made[0][:n], made[1][:n]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _joined(hashes: list[np.ndarray]) -> np.ndarray:
    """A hash of several words in their order."""
    total = hashes[0]
    for h in hashes[1:]:
        total = _mix(total * _BASE + h)
    return total


def parse(texts: pa.Array, how: Mining) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of the text, chunk, whether it is the text's last) of all chunks.

    A chunk is the text from its first word to its last, in lower case. Texts without words have
    none; texts too short to be cut are one.
    """
    words = Words(texts)
    n, shared = len(words.start), how.longest - 1
    last = np.ones(n, bool)
    last[:-1] = words.text[1:] != words.text[:-1]
    begins = np.roll(last, 1) if n else last
    hit = np.zeros(n, bool)
    if n >= shared:
        window = _joined([words.hash[i : n - shared + 1 + i] for i in range(shared)])
        hit[shared - 1 :] = window % np.uint64(how.chunk_words) == 0
    # The window lies within one text, and the chunk has at least one word that the next has not.
    place = np.arange(n) - np.maximum.accumulate(np.where(begins, np.arange(n), 0)) if n else np.arange(0)
    cut = np.flatnonzero(hit & (place >= shared) & ~last)
    starts = np.sort(np.concatenate([np.flatnonzero(begins), cut - shared + 1]))
    ends = np.sort(np.concatenate([np.flatnonzero(last), cut]))
    return words.text[starts], words.slices(words.start[starts], words.end[ends]), last[ends]


# -- counting inside chunks -----------------------------------------------------


class Frequent:
    """A table of bits: those of frequent phrases are set, and a few others."""

    def __init__(self, log: int, bits: np.ndarray):
        self.log, self.bits = log, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = slots(hashes, self.log)
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def slots(hashes: np.ndarray, log: int) -> np.ndarray:
    return hashes >> np.uint64(64 - log)


def count(
    langs: pa.Array, chunks: pa.Array, last: np.ndarray, times: np.ndarray, n: int, how: Mining, frequent: Frequent | None
) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(lang, phrase, f) of the phrases of ``n`` words that the chunks own and ``frequent`` admits."""
    words = Words(chunks)
    total = len(words.start)
    places = max(0, total - n + 1)
    ok = np.ones(places, bool)
    for i in range(1, n):
        ok &= ~words.opens[i : places + i]
    # The last ``longest - 1`` words of a chunk begin nothing here, unless no chunk follows.
    after = np.cumsum(np.bincount(words.text, minlength=len(chunks)))[words.text[:places]] if total else np.zeros(0, int)
    ok &= last[words.text[:places]] | (np.arange(places) < after - (how.longest - 1))
    at = np.flatnonzero(ok)
    coded = langs.dictionary_encode()
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.text[at]]
    if frequent is not None:
        salt = np.array([_lang_hash(v.as_py()) for v in coded.dictionary], np.uint64)[lang]
        for part in (0, 1):
            inner = phrase_hash([words.hash[at + part + i] for i in range(n - 1)], salt)
            keep = frequent(inner)
            at, lang, salt = at[keep], lang[keep], salt[keep]
    texts = words.slices(words.start, words.end).dictionary_encode()
    code = texts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds = len(texts.dictionary)
    # Phrases are numbered by their words step by step, so no number passes words times words.
    group = lang
    for i in range(n):
        group = np.unique(group * kinds + code[at + i], return_inverse=True)[1]
    size = int(group.max()) + 1 if len(group) else 0
    f = _sums(group, times[words.text[at]], size)
    sample = np.zeros(size, np.int64)
    sample[group] = np.arange(len(group))
    phrase = [pc.take(texts.dictionary, pa.array(code[at[sample] + i])) for i in range(n)]
    joined = phrase[0] if n == 1 else pc.binary_join_element_wise(*phrase, pa.scalar(" ", pa.large_string()))
    return pc.take(coded.dictionary, pa.array(lang[sample])), joined, f


def _sums(group: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """Exact whole sums per group."""
    f = np.zeros(size, np.int64)
    np.add.at(f, group, times)
    return f


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest())


def phrase_hash(words: list[np.ndarray], salt: np.ndarray) -> np.ndarray:
    return _joined([salt, *words])


# -- tables ---------------------------------------------------------------------


def dictionary(docs: DataFrame, how: Mining = Mining(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, chunk, last, times): the distinct chunks and how often the parse has them."""
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text")
    ).filter("text IS NOT NULL")

    def chunked(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _sized(tables, "text"):
            text, chunk, last = parse(table.column("text"), how)
            lang = pc.take(table.column("lang"), pa.array(text))
            yield pa.RecordBatch.from_arrays([lang, chunk.cast(pa.string()), pa.array(last)], names=["lang", "chunk", "last"])

    chunks = rows.mapInArrow(chunked, "lang string, chunk string, last boolean")
    return chunks.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("times"))


def _sized(tables: Iterable[pa.RecordBatch], column: str, limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes in ``column``, or of one longer row."""
    held, size = [], 0
    for table in tables:
        sizes = pc.binary_length(table.column(column)).to_numpy(zero_copy_only=False)
        so_far, at = np.cumsum(sizes), 0
        while at < table.num_rows:
            room = (so_far[at - 1] if at else 0) + max(0, limit - size)
            to = max(at + (not held), int(np.searchsorted(so_far, room, "right")))
            if to > at:
                held.append(table.slice(at, to - at))
                size += int(sizes[at:to].sum())
            if to < table.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
            at = to
    if held:
        yield pa.concat_batches(held)


def counted(chunks: DataFrame, n: int, how: Mining, frequent=None) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``n`` words; ``frequent`` is a broadcast ``Frequent``."""

    def counts(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        admitted = None if frequent is None else frequent.value
        for table in _sized(tables, "chunk"):
            lang, phrase, f = count(
                table.column("lang"),
                table.column("chunk"),
                table.column("last").to_numpy(zero_copy_only=False),
                table.column("times").to_numpy(),
                n,
                how,
                admitted,
            )
            columns = [lang, phrase.cast(pa.string()), pa.array(f)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    found = chunks.mapInArrow(counts, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def admitted(phrases: DataFrame, rows: int) -> Frequent:
    """The bits of all ``phrases``: tasks give the words they set, words meet by a bitwise or. What
    comes to the driver is bounded by the size of the table."""
    log = int(np.clip(np.ceil(np.log2(max(1, rows) * BITS_EACH)), LEAST_LOG, MOST_LOG))

    def places(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            words = Words(table.column("phrase"))
            salt = [_lang_hash(v) for v in table.column("lang").to_pylist()]
            first = np.flatnonzero(np.diff(words.text, prepend=-1))
            size = np.bincount(words.text, minlength=table.num_rows)
            total = np.array(salt, np.uint64)
            for i in range(int(size.max(initial=0))):
                longer = size > i
                total[longer] = _joined([total[longer], words.hash[first[longer] + i]])
            slot = slots(total, log)
            bit = np.uint64(1) << (slot & np.uint64(63))
            columns = [pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "bits"])

    set_words = phrases.select("lang", "phrase").mapInArrow(places, "word long, bits long")
    set_words = set_words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = set_words.toArrow()
    table = np.zeros(1 << (log - 6), "<i8")
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Frequent(log, table.view(np.uint8))


def collocations(docs: DataFrame, how: Mining = Mining(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    ``a`` is how often a phrase occurs, ``l`` and ``r`` how often its parts at the cut that scores
    least, ``n`` how many words the language has, all in long; score is
    ``floor(1000000 * a * a / (l * r))``. Null language: ``und``. Null and empty texts and texts
    without words count for nothing. Repeated rows count each. Ranks have no ties, as phrases are
    distinct. Empty table: empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    chunks = stage(dictionary(docs, how, text, lang), "phrase-chunks", "zstd")
    words = stage(counted(chunks, 1, how), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    by_length, bits = {1: stage(words.filter(F.col("f") >= how.least), "phrases")}, None
    for n in range(2, how.longest + 1):
        shorter = by_length[n - 1]
        bits = spark.sparkContext.broadcast(admitted(shorter, shorter.count()))
        by_length[n] = stage(counted(chunks, n, how, bits).filter(F.col("f") >= how.least), "phrases")
    drop_stage(chunks)
    scored = [_kept(by_length, n, how) for n in range(2, how.longest + 1)]
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = every.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= how.keep)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _kept(by_length: dict[int, DataFrame], n: int, how: Mining) -> DataFrame:
    """The candidates of ``n`` words with the cut that scores least, without those that a longer
    candidate covers. A longest cover has one word more: of longer ones, parts of that length occur
    as often or more, and are candidates too."""
    found = by_length[n].select("lang", "phrase", F.col("f").alias("a"))
    word = F.split("phrase", " ")
    for k in range(1, n):
        left = F.array_join(F.slice(word, 1, k), " ")
        right = F.array_join(F.slice(word, k + 1, n - k), " ")
        found = _looked_up(found, left, by_length[k], f"l{k}")
        found = _looked_up(found, right, by_length[n - k], f"r{k}")
    cuts = [
        F.struct(score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in range(1, n)
    ]
    least = cuts[0] if len(cuts) == 1 else F.least(*cuts)
    found = found.withColumn("cut", least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    if n + 1 not in by_length:
        return found
    longer = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(longer, 1, n), " "), F.array_join(F.slice(longer, 2, n), " "))
    covers = by_length[n + 1].select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase")
    joined = found.join(covers.agg(F.max("f").alias("most")), ["lang", "phrase"], "left")
    return joined.filter(~F.coalesce(100 * F.col("most") >= how.covered * F.col("a"), F.lit(False))).drop("most")


def _looked_up(found: DataFrame, part: Column, counts: DataFrame, name: str) -> DataFrame:
    """``found`` with the count of a part of each phrase. A part that very many phrases share is
    met in as many tasks as there are salts."""
    salted = found.withColumn("_part", part).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    spread = counts.select(
        "lang",
        F.col("phrase").alias("_part"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
        F.col("f").alias(name),
    )
    return salted.join(spread, ["lang", "_part", "_salt"]).drop("_part", "_salt")


def score(a: str, left: str, right: str) -> Column:
    """In whole numbers of 38 digits, which hold the products while ``a`` is below 10**16."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    above = F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a)
    return F.call_function("div", above, whole(left) * whole(right))
