"""Token ids, packing and token files against the library and exact round trips."""

import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from docs import odd_rows, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quotemill.llm import packing, token_files, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
CONFIG = open(PATH, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZé'’s t\n\x1c\xa0 <|>0́ΣİÅ ")), max_size=60))
def test_word_by_word_equals_the_library(text):
    coder = tokens.encoder(CONFIG)
    assert np.frombuffer(coder.text(text), coder.dtype).tolist() == ids_of(text)


def test_memory_is_bounded():
    coder = tokens.Encoder(CONFIG, words_kept=5)
    for i in range(50):
        assert np.frombuffer(coder.text(f"a{i} b{i} 's"), "<u2").tolist() == ids_of(f"a{i} b{i} 's")
    assert len(coder.words) < 12


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = tokens.Encoder(open(path, encoding="utf-8").read())
    text = "Hello  there\n\nyou"
    assert np.frombuffer(coder.text(text), coder.dtype).tolist() == Tokenizer.from_file(path).encode(text).ids


def test_pieces_cover_each_document_once(spark):
    rows = odd_rows() + [(100 + i, "stone river " * (i * 7 % 90), "en", "web", 0) for i in range(80)]
    small = packing.Packing(window=64, shard_tokens=3000)
    got = packing.pack(table(spark, rows), CONFIG, small).collect()
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append(np.array([*ids_of(text), 2], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        assert p["length"] * 4 == len(p["ids"]) and p["length"] > 0
        pieces[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for key, expected in texts.items():
        made = sum(p["length"] for p in pieces[key])
        assert made == sum(map(len, expected))
        if len(expected) == 1:
            mine = sorted(pieces[key], key=lambda p: p["start"])
            assert [p["start"] for p in mine] == list(itertools.accumulate([0] + [p["length"] for p in mine]))[:-1]
            assert b"".join(p["ids"] for p in mine) == expected[0].tobytes()
            assert {p["doc_tokens"] for p in mine} == {len(expected[0])}
    fills = defaultdict(list)
    for sequence, mine in sequences.items():
        mine.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in mine] == list(itertools.accumulate([0] + [p["length"] for p in mine]))[:-1]
        fills[sequence >> 32].append(sum(p["length"] for p in mine))
    for fill in fills.values():
        assert max(fill) <= 64 and sum(f < 64 for f in fill) <= 1
    assert len(fills) > 3
    again = packing.pack(table(spark, rows), CONFIG, small).count()
    assert again == len(got)
    assert packing.pack(table(spark, []), CONFIG).count() == 0


def test_neighbours_come_from_the_whole_corpus(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_IDS", 1000)
    words = "stone river cloud maple garden window silver mountain letter bridge castle forest".split()
    rng = np.random.default_rng(3)
    vocabulary = [f"{a} {b}" for a in words for b in words]
    rows = []
    for pair in range(120):
        own = " ".join(rng.choice(vocabulary, 6)) + f" {pair * 7919} " * 6
        rows += [(pair, own, "en", "web", 0), (500 + pair, own + " the", "en", "web", 0)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    got = packing.pack(table(spark, rows), CONFIG, packing.Packing(window=128, shard_tokens=512)).collect()
    windows = defaultdict(set)
    for p in got:
        windows[p["doc_id"]].add(p["sequence_id"])
    total = sum(p["length"] for p in got)
    assert total > 12 * 512
    together = sum(bool(windows[pair] & windows[500 + pair]) for pair in range(120))
    assert together >= 80
    fill = defaultdict(int)
    for p in got:
        fill[p["sequence_id"]] += p["length"]
    assert sum(f < 128 for f in fill.values()) <= 1 and max(fill.values()) == 128


def block_of(items, idf, doc=None):
    found = [np.unique(x, return_counts=True) for x in items]
    return packing.Block(
        np.arange(len(items)) if doc is None else doc, np.array([len(x) for x in items]), np.concatenate([t for t, _ in found]),
        np.concatenate([c for _, c in found]), np.array([len(t) for t, _ in found]), idf, 25.0, packing.Packing(),
    )


def test_a_block_hands_on_only_what_can_enter_a_list():
    rng = np.random.default_rng(6)
    items = [rng.integers(0, 300, rng.integers(1, 60)) for _ in range(90)]
    block, asked = block_of(items, rng.random(300) + 0.1), [np.unique(x) for x in items]
    seeds, most = np.arange(90), np.full(90, 5)
    alone = [np.concatenate(x) for x in zip(*block.best(seeds, asked, most, np.full(90, -np.inf, np.float32), 90))]
    place, doc, score = packing._best(*alone, most)
    every = block.scores(asked) - np.stack([block._ties(np.arange(90), s, 90) for s in seeds])
    for q in range(90):
        assert doc[place == q].tolist() == np.lexsort((np.arange(90), -every[q]))[:5].tolist()
    least = packing._least(place, score, most)
    assert (least == np.sort(every, axis=1)[:, -5]).all()
    least[::2] += 1
    again = [np.concatenate(x) for x in zip(*block.best(seeds, asked, most, least, 90))]
    assert len(again[0]) == (every >= least[:, None]).sum() < 5 * 90
    assert (packing._least(place[:-1], score[:-1], most)[-1]) == -np.inf


@pytest.mark.parametrize("copies", [1, 40])
def test_lists_in_steps_are_those_of_one_index(spark, monkeypatch, copies):
    monkeypatch.setattr(packing, "ROUND_ENTRIES", 1)
    rng = np.random.default_rng(7)
    items = [rng.integers(0, 300, rng.integers(1, 60)).astype("<u2") for _ in range(200 // copies)] * copies
    idf, n = rng.random(300) + 0.1, len(items)
    rows = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(items)], "doc long, rest binary")
    left = np.array([len(x) for x in items], np.int64)
    left[rng.integers(0, n, 30)] = 0
    seeds = np.nonzero(left)[0][:60]
    most = rng.integers(1, 20, 60)
    known = spark.sparkContext.broadcast((idf, 25.0))
    blocks = packing._blocks(rows, 37, "<u2").cache()
    got = packing._neighbours(blocks, 37, seeds, most, left, known, "<u2", packing.Packing())
    unused = np.nonzero(left)[0]
    whole = block_of([items[i] for i in unused], idf, unused)
    scores = whole.scores([np.unique(items[s]) for s in seeds])
    assert len(packing._steps(37)) == 3
    for i, s in enumerate(seeds):
        final = scores[i] - whole._ties(unused, s, n)
        assert len(got[i]) == most[i]
        ranked = final[np.searchsorted(unused, got[i])]
        # Blocks add up in another order, so scores agree but for the last bits.
        assert np.allclose(ranked, np.sort(final)[::-1][: most[i]], rtol=1e-4)


@pytest.mark.parametrize("count, expected", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 3), (3, 9)]), (129, [(0, 3), (3, 9), (9, 33), (33, 129)])])
def test_steps_cover_all_blocks(count, expected):
    assert packing._steps(count) == expected


def test_blocks_score_as_the_index():
    rng = np.random.default_rng(4)
    items = [rng.integers(0, 300, rng.integers(1, 60)) for _ in range(90)]
    idf = rng.random(300) + 0.1
    index = packing.Index(items, idf, 25.0, 1.2, 0.75)
    found = [np.unique(x, return_counts=True) for x in items]
    block = packing.Block(
        np.arange(90), np.array([len(x) for x in items]), np.concatenate([t for t, _ in found]),
        np.concatenate([c for _, c in found]), np.array([len(t) for t, _ in found]), idf, 25.0, packing.Packing(),
    )
    got = block.scores([t for t, _ in found])
    assert len(block.item) and len(block.dense)
    for q in range(90):
        assert np.allclose(got[q], index.scores(q), rtol=1e-4)


def test_index_scores_are_bm25():
    rng = np.random.default_rng(1)
    items = [rng.integers(0, 30, rng.integers(1, 60)).astype("<u2") for _ in range(20)]
    within = rng.integers(1, 20, 30)
    idf = np.log(1 + (20 - within + 0.5) / (within + 0.5))
    index = packing.Index(items, idf, 25.0, 1.2, 0.75)
    for q in (0, 7):
        for d, item in enumerate(items):
            expected = 0.0
            for t in set(items[q].tolist()):
                tf = int((item == t).sum())
                expected += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(item) / 25.0)) if tf else 0
            assert math.isclose(index.scores(q)[d], expected, rel_tol=1e-9, abs_tol=1e-12)


def test_windows_take_the_best_neighbours():
    likes = {0: [0, 1, 9, 5, 0], 1: [0, 0, 0, 0, 0], 3: [0, 1, 0, 0, 0]}
    ranked = lambda i: np.array(likes.get(i, [0] * 5), float)
    got = list(packing.fill_windows(np.array([4, 5, 3, 9, 2]), ranked, 10))
    # After 0 its best neighbour 2, then 4, as neither 3 nor 1 fits whole any more. Nothing fits the
    # last place, so 3, the best that is left, is cut and opens the next window; so is 1.
    assert got == [(0, 0, 4, 0, 0), (2, 0, 3, 0, 4), (4, 0, 2, 0, 7), (3, 0, 1, 0, 9), (3, 1, 8, 1, 0), (1, 0, 2, 1, 8), (1, 2, 3, 2, 0)]


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    monkeypatch.setattr(token_files, "PART_IDS", 20_000)
    rows = odd_rows() + [(100 - i, "stone river " * (i * 7 % 90), "en", "web", 0) for i in range(50)]
    path = str(tmp_path / "files")
    token_files.write(table(spark, rows), path, CONFIG, end_id=1)
    got = sorted((tuple(r) for r in token_files.read(spark, path).collect()), key=lambda r: r[1])
    assert len(got) == len(rows)
    keys = [r[0] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r[1] for r in got] == list(itertools.accumulate([0] + [r[2] for r in got]))[:-1]
    expected = sorted((str(k), zlib.crc32(np.array([*ids_of(t), 1], "<u4").tobytes())) for k, t, *_ in rows)
    assert sorted((str(r[0]), zlib.crc32(r[3])) for r in got) == expected
    assert all(len(r[3]) == 4 * r[2] for r in got)
    stored = spark.read.parquet(path + "/segments")
    assert stored.count() > 5 and stored.select("part").distinct().count() > 1


@pytest.mark.parametrize(
    "keys",
    [
        [2**60 + 7 * i for i in range(400)],
        [2**63 - 1 - i for i in range(200)] + [-(2**63) + i for i in range(200)],
        [None] * 400,
        [None] * 250 + [5] * 150,
        [2**62] * 400,
    ],
)
def test_files_keep_the_order_of_all_keys(spark, tmp_path, monkeypatch, keys):
    """64-bit keys that doubles cannot tell apart, and keys and nulls that fill several parts."""
    monkeypatch.setattr(token_files, "PART_IDS", 300)
    rows = [(k, f"stone {i}", "en", "web", 0) for i, k in enumerate(keys)]
    path = str(tmp_path / "files")
    token_files.write(table(spark, rows), path, CONFIG, end_id=1)
    got = sorted((tuple(r) for r in token_files.read(spark, path).collect()), key=lambda r: r[1])
    found = [r[0] for r in got]
    assert found == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r[1] for r in got] == list(itertools.accumulate([0] + [r[2] for r in got]))[:-1]
    sizes = spark.read.parquet(path + "/segments").groupBy("part").agg({"segment": "count"}).count()
    assert sizes > 2


def test_files_need_numbers_as_keys(spark, tmp_path):
    with pytest.raises(TypeError):
        token_files.write(spark.createDataFrame([("a", "x")], "doc_id string, text string"), str(tmp_path / "f"), CONFIG, end_id=1)


def test_files_of_an_empty_table(spark, tmp_path):
    token_files.write(table(spark, []), str(tmp_path / "none"), CONFIG, end_id=1)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def test_code_is_optimal_within_its_limit():
    rng = np.random.default_rng(2)
    for n, limit in ((5, 3), (6, 4), (6, 3), (7, 3)):
        counts = rng.integers(1, 60, n) ** 2
        got = token_files.code_lengths(counts, limit)
        options = (x for x in itertools.product(range(1, limit + 1), repeat=n) if sum(2.0**-l for l in x) <= 1)
        assert (got * counts).sum() == min((np.array(x) * counts).sum() for x in options)
        assert got.max() <= limit and sum(2.0 ** -got) <= 1
    assert token_files.code_lengths(np.array([0, 3, 0]), 4).tolist() == [0, 1, 0]
    assert token_files.code_lengths(np.zeros(3), 4).tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9), 3)


def test_code_words_are_canonical():
    codes = token_files.canonical_codes(np.array([2, 0, 3, 1, 3]))
    assert codes.tolist() == [0b10, 0, 0b110, 0b0, 0b111]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=700), max_size=8), st.integers(6, 18))
def test_blocks_decode_on_their_own(lists, limit):
    arrays = [np.array(x, "<u2") for x in lists]
    counts = np.bincount(np.concatenate([*arrays, np.zeros(0, "<u2")]).astype(np.int64), minlength=41)
    lengths = token_files.code_lengths(counts, limit)
    decoder = token_files.Decoder(lengths)
    if not arrays:
        return
    for ids, (payload, marks) in zip(arrays, token_files.encode_ids(arrays, token_files.canonical_codes(lengths), lengths)):
        sizes = np.full(len(marks), token_files.BLOCK_IDS)
        if len(marks):
            sizes[-1] = len(ids) - token_files.BLOCK_IDS * (len(marks) - 1)
        assert decoder.blocks(payload, marks, sizes).tolist() == ids.tolist()
        for i in range(len(marks)):
            alone = decoder.blocks(payload, marks[i : i + 1], sizes[i : i + 1])
            assert alone.tolist() == ids[i * token_files.BLOCK_IDS :][: sizes[i]].tolist()
