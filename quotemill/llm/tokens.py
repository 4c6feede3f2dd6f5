"""Token ids of whole texts, by the tokenizers library, with a memory of words.

A tokenizer that drops white space gives a text the ids of its words, one after the other. Words
repeat, so each worker keeps the ids of words, and of their letter runs, that it has met, up to a
bound. A word that is new goes to the library: to its BPE model where normalising is no more than
lower case, to its whole pipeline otherwise. Tokenizers of another make get whole texts.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

#: Words kept by a worker before it forgets all; about 200 bytes each.
WORDS_KEPT = 800_000
#: Letters that are composed, have one lower-case letter and depend on no neighbour.
PLAIN = re.compile("[\x21-\x7eÀ-įı-ſ]+")
#: White space for Python, but not for the tokenizer.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class _Memory(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Ids as little-endian bytes of ``dtype``, the smallest of two types that holds every id."""

    def __init__(self, config: str, words_kept: int = WORDS_KEPT):
        self.library = Tokenizer.from_str(config)
        self.dtype = id_type(self.library.get_vocab_size(with_added_tokens=True))
        self.words_kept = words_kept
        made = json.loads(config)
        self.pattern = _word_pattern(made)
        self.added = [t["content"] for t in made.get("added_tokens") or []]
        self.words, self.runs = _Memory(self._word), _Memory(self._run)
        self.bytes = {}
        if self.pattern:
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            codes = [*range(0x21, 0x7F), *range(0xC0, 0x130), *range(0x131, 0x180)]
            self.bytes = {code: level.pre_tokenize_str(chr(code))[0][0] for code in codes}

    def text(self, text: str) -> bytes:
        if not self.pattern or any(c in text for c in SEPARATORS):
            return self._whole(text)
        if len(self.words) > self.words_kept:
            self.words.clear()
        if len(self.runs) > self.words_kept:
            self.runs.clear()
        return b"".join(map(self.words.__getitem__, text.split()))

    def _whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.runs[word.lower()]
        if PLAIN.fullmatch(word) and not any(t in word for t in self.added):
            return b"".join(map(self.runs.__getitem__, self.pattern.findall(word.lower())))
        return self._whole(word)

    def _run(self, run: str) -> bytes:
        if not run.isascii():
            run = run.translate(self.bytes)
        return self.packed([t.id for t in self.library.model.tokenize(run)])

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype == '<u2' else 'I'}", *ids)


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 2**16 else "<u4"


def _word_pattern(made: dict):
    """The pattern of word parts, where the tokenizer is of the kind that can go word by word."""
    steps = (made.get("normalizer") or {}).get("normalizers") or []
    first = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    plain = [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
    split = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    kept = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in made.get("added_tokens") or [])
    pattern = (first.get("pattern") or {}).get("Regex", "")
    if plain and split and kept and steps[1]["pattern"] == {"Regex": "\\s+"} and "[^\\s" in pattern:
        return regex.compile(pattern)
    return None


def vocabulary_size(config: str) -> int:
    return Tokenizer.from_str(config).get_vocab_size(with_added_tokens=True)


_ENCODERS: dict[int, Encoder] = {}


def encoder(config: str) -> Encoder:
    """The worker's encoder of this configuration; it lives as long as the worker."""
    key = hash(config)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(config)
    return _ENCODERS[key]


def encode(df: DataFrame, config: str, text: str, end_id: int | None, out: str = "ids") -> DataFrame:
    """``df`` with the column ``text`` replaced by ``out``: the ids of the whole text, then
    ``end_id``, as bytes. Null text: as empty. The configuration is broadcast; its size is that of
    the vocabulary."""
    shared = df.sparkSession.sparkContext.broadcast(config)
    names = [c for c in df.columns if c != text]
    schema = df.select(*names, F.lit(None).cast("binary").alias(out)).schema

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            coder = encoder(shared.value)
            end = b"" if end_id is None else np.array([end_id], coder.dtype).tobytes()
            column = table.column(text)
            done, at = [], 0
            for i in range(len(column)):
                value = column[i].as_py()
                done.append(coder.text(value) + end if value else end)
                if len(done) == 1024 or i == len(column) - 1:
                    part = table.slice(at, len(done))
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in names], pa.array(done, pa.binary())], names=[*names, out]
                    )
                    done, at = [], i + 1

    return df.mapInArrow(batches, schema)


def counts(df: DataFrame, vocabulary: int, ids: str = "ids", per_document: bool = False) -> np.ndarray:
    """How often each id occurs in all rows, or in how many rows. Tasks sum first, and the result
    has ``vocabulary`` numbers whatever the data."""
    kind = id_type(vocabulary)

    def batches(tables: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for table in tables:
            lists = [np.frombuffer(v.as_py(), kind) for v in table.column(0)]
            if per_document:
                lists = [np.unique(x) for x in lists]
            if lists:
                total += np.bincount(np.concatenate(lists), minlength=vocabulary)
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    found = df.select(ids).mapInArrow(batches, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(vocabulary, np.int64)
    for row in found.collect():
        out[row["id"]] = row["n"]
    return out
