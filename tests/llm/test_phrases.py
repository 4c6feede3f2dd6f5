"""Phrases: chunks that cover each text once, counts and ranks against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from docs import odd_rows, table
from hypothesis import given, settings
from hypothesis import strategies as st

from quotemill.llm import phrases
from quotemill.llm.phrases import Mining

LETTERS = st.text(st.sampled_from("aAbé .,\n\t\x0b\x1c\xa0😀"), max_size=60)


def pieces_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def grams(rows, n):
    f = Counter()
    for text, lang in rows:
        for words in pieces_of(text):
            for i in range(len(words) - n + 1):
                f[lang or "und", " ".join(words[i : i + n])] += 1
    return f


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, max_size=8))
def test_words_are_the_pattern_s(texts):
    words = phrases.Words(pa.array(texts, pa.string()))
    got = list(zip(words.text.tolist(), words.opens.tolist(), words.slices(words.start, words.end).to_pylist()))
    expected = []
    for i, text in enumerate(texts):
        for piece in pieces_of(text):
            expected += [(i, j == 0, w) for j, w in enumerate(piece)]
    assert got == expected
    by_hash = dict(zip(words.hash.tolist(), (w for *_, w in got)))
    assert len(by_hash) == len({w for *_, w in got})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab ,"), max_size=80), max_size=6), st.integers(2, 4), st.integers(1, 4))
def test_chunks_own_each_phrase_once(texts, longest, every):
    how = Mining(longest=longest, chunk_words=every)
    text, chunk, last = phrases.parse(pa.array(texts, pa.string()), how)
    langs, one = pa.array(["x"] * len(chunk), pa.string()), np.ones(len(chunk), np.int64)
    for n in range(1, longest + 1):
        lang, phrase, f = phrases.count(langs, chunk, last, one, n, how, None)
        got = {("x", p): int(k) for p, k in zip(phrase.to_pylist(), f)}
        assert got == dict(grams([(t, "x") for t in texts], n))


def test_equal_passages_are_cut_alike():
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(2000))
    _, chunk, last = phrases.parse(pa.array(["one two " + passage, "three, " + passage + " end"]), Mining())
    times = Counter(zip(chunk.to_pylist(), last.tolist()))
    assert len(times) < 0.6 * len(chunk) and 30 < len(chunk) < 300


def expected(rows, how):
    f = {n: grams(rows, n) for n in range(1, how.longest + 1)}
    total = Counter()
    for (lang, _), k in f[1].items():
        total[lang] += k
    found, most = defaultdict(list), Counter()
    for n in range(3, how.longest + 1):
        for (lang, longer), b in f[n].items():
            w = longer.split(" ")
            for m in range(2, n) if b >= how.least else ():
                for i in range(n - m + 1):
                    key = lang, " ".join(w[i : i + m])
                    most[key] = max(most[key], b)
    for n in range(2, how.longest + 1):
        for (lang, phrase), a in f[n].items():
            if a < how.least:
                continue
            w = phrase.split(" ")
            cuts = []
            for k in range(1, n):
                left, right = f[k][lang, " ".join(w[:k])], f[n - k][lang, " ".join(w[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            if 100 * most[lang, phrase] < how.covered * a:
                score, _, left, right = min(cuts)
                found[lang].append((-score, -a, phrase.encode(), phrase, left, right))
    out = []
    for lang, each in found.items():
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(each)[: how.keep], 1):
            out.append((lang, rank, phrase, -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(
    "how", [Mining(), Mining(least=3, keep=40, chunk_words=4), Mining(longest=4, least=2, keep=10**6, chunk_words=3)]
)
def test_whole_table_against_counters(spark, how):
    rows = odd_rows() + [
        (100 + i, f"The Red fox, jumped over red fox jumped {'x y ' * (i % 5)}! q{i % 7} q{i % 3}\nnew york city ü ü", lang, "web", 0)
        for i in range(60)
        for lang in ("en", None, "de")[: 1 + i % 3]
    ]
    got = phrases.collocations(table(spark, rows), how).collect()
    assert sorted(map(tuple, got)) == expected([(r[1], r[2]) for r in rows], how)


def test_small_tables(spark):
    assert phrases.collocations(table(spark, [])).count() == 0
    assert phrases.collocations(table(spark, [(1, None, None, None, None), (2, " .", "en", None, None)])).count() == 0


def test_products_beyond_64_bits(spark):
    a = spark.createDataFrame([(3_000_000_000, 3_000_000_001, 4_000_000_003)], "a long, l long, r long")
    assert a.select(phrases.score("a", "l", "r")).first()[0] == 10**6 * 3_000_000_000**2 // (3_000_000_001 * 4_000_000_003)


def test_a_full_table_of_bits_loses_nothing(spark):
    full = phrases.Frequent(8, np.full(32, 255, np.uint8))
    texts = pa.array(["a b c a b c d", "a b"])
    how = Mining()
    _, chunk, last = phrases.parse(texts, how)
    langs, one = pa.array(["x"] * len(chunk)), np.ones(len(chunk), np.int64)
    for n in (2, 3):
        got = phrases.count(langs, chunk, last, one, n, how, full)
        assert dict(zip(got[1].to_pylist(), got[2])) == {p: k for (_, p), k in grams([("a b c a b c d", "x"), ("a b", "x")], n).items()}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=9), max_size=9), max_size=5), st.integers(1, 20))
def test_batches_keep_their_rows(batches, limit):
    tables = [pa.RecordBatch.from_arrays([pa.array(b, pa.string())], names=["t"]) for b in batches]
    sized = list(phrases._sized(tables, "t", limit))
    assert [x for b in sized for x in b.column("t").to_pylist()] == [x for b in batches for x in b]
    for batch in sized:
        sizes = [len(x) for x in batch.column("t").to_pylist()]
        assert sum(sizes) - max(sizes) <= limit
