"""The n-gram join against all pairs."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from docs import odd_rows, table

from quotemill.llm import ngram_join
from quotemill.llm.ngram_join import Join
from quotemill.llm.staging import shared_folder, stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_classes(rows):
    """{id: (size, class)}; ids must be distinct."""
    sets = {r[0]: plain_set(r[1]) for r in rows}
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus(seed, groups=12, hot=40):
    """Groups of edited copies, one of them large, and passages that unrelated texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(30)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(8, 120))]
        if g % 3 == 0:
            base[4:4] = passage
        for _ in range(hot if g == 0 else rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[rng.randint(0, 5) :]
            texts.append(" ".join(copy).title() if rng.random() < 0.2 else "\n ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(0, 14))]) for _ in range(30)]
    texts += [None, "", " ", "a", "A", "a b", "a b c d", "a b c d e", "x " * 400, "x " * 500]
    rng.shuffle(texts)
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,join", [(1, Join()), (2, Join(verify_cost=1e3, emit_cost=0)), (3, Join(verify_cost=0))])
def test_classes_equal_all_pairs(spark, monkeypatch, seed, join):
    monkeypatch.setattr(ngram_join, "PART_ENTRIES", 700)
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_KEYS", 12)
    monkeypatch.setattr(ngram_join, "ENVOYS", 2)
    rows = corpus(seed)
    got = ngram_join.classes(table(spark, rows), join).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_classes(rows)
    assert len(got) == len(rows)


def test_odd_rows(spark):
    got = ngram_join.classes(table(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert of[6] == {(36, 6)} and of[40] == {(36, 6)}
    assert of[0] == {(0, 0)} and of[1] == {(0, 1)}
    assert of[None] == {(0, None), (of[7].copy().pop()[0], 7)}
    assert ngram_join.classes(table(spark, [])).count() == 0


def test_shingle_sets_equal_plain_sets():
    texts = [r[1] or "" for r in corpus(9) + odd_rows()]
    got = ngram_join.shingle_sets([t.encode() for t in texts], 5)
    expected = [plain_set(t) for t in texts]
    assert [len(g) for g in got] == [len(e) for e in expected]
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            assert len(np.intersect1d(got[i], got[j])) == len(expected[i] & expected[j])


def test_costly_prefixes_get_longer():
    rare = np.full(100, 2.0)
    m, length = ngram_join.matches_and_prefix(rare, 1000.0, Join())
    costly, more = ngram_join.matches_and_prefix(np.full(100, 500.0), 0.0, Join(emit_cost=1000.0))
    assert 1 < m < costly and length == 25 + m and more == 25 + costly
    assert ngram_join.matches_and_prefix(rare, 1000.0, Join(verify_cost=0)) == (1, 26)
    assert ngram_join.matches_and_prefix(np.ones(1), 0.0, Join()) == (1, 1)


def test_frequency_table_grows_with_the_text(spark, monkeypatch):
    """A table of fixed size fills up, and then prefixes hold what many documents quote."""
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) + " a passage that all of them quote" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    assert ngram_join.table_bits(docs) == ngram_join.LEAST_BITS
    assert ngram_join.table_bits(docs.limit(0)) == ngram_join.LEAST_BITS
    size = sum(len(t.encode()) for t in texts)
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 10)
    monkeypatch.setattr(ngram_join, "PLACE_BYTES", 4)
    assert 2 ** (ngram_join.table_bits(docs) - 1) < size / 4 <= 2 ** ngram_join.table_bits(docs)
    monkeypatch.setattr(ngram_join, "MOST_BITS", 12)
    assert ngram_join.table_bits(docs) == 12
    for bits in (20, 23):
        levels = ngram_join._frequencies(ngram_join._described(docs, bits, Join()), bits)
        counts = np.zeros(1 << bits, np.int64)
        for found in ngram_join.shingle_sets([t.encode() for t in texts], 5):
            counts[np.unique(found >> np.uint64(64 - bits)).astype(np.int64)] += 1
        assert len(levels) == len(counts) and counts.max() >= 60
        assert np.allclose(ngram_join.LEVELS[levels], counts, rtol=0.1)
        assert (levels > 0).tolist() == (counts > 0).tolist()


def test_staged_tables_go_after_their_last_reader(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_KEYS", 12)
    root = Path(shared_folder(spark).removeprefix("file:")) / "quotemill-llm"
    before = set(root.glob("*"))
    ngram_join.classes(table(spark, corpus(6))).collect()
    assert {p.name.rsplit("-", 5)[0] for p in set(root.glob("*")) - before} == {"members"}


def test_connected(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 101 + i) for i in range(30)]
    rng.shuffle(chain)
    links = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star + [(7, 7)]], "a long, b long")
    roots = {r["key"]: r["root"] for r in ngram_join.connected(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 131)}}
    assert ngram_join.connected(links.limit(0)).count() == 0


def test_connected_in_parts_and_in_one(spark, monkeypatch):
    """Few edges need no rounds; beyond, parts are starred first and rounds complete them."""
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(80)] + [(200, 201 + i) for i in range(20)]
    rng.shuffle(chain)
    links = spark.createDataFrame(chain, "a long, b long")
    expected = {**{i: 0 for i in range(81)}, **{i: 200 for i in range(200, 221)}}
    rounds, starred = [], ngram_join._starred
    monkeypatch.setattr(ngram_join, "_starred", lambda edges: rounds.append(1) or starred(edges))
    for most, used in ((1000, 0), (8, 1)):
        monkeypatch.setattr(ngram_join, "STAR_EDGES", most)
        roots = ngram_join.connected(links).collect()
        assert len(roots) == len(expected) and {r["key"]: r["root"] for r in roots} == expected
        assert len(rounds) == used


def test_shares_of_the_frequency_table_are_small_and_add_up():
    rng = np.random.default_rng(5)
    total, expected = np.zeros(1 << ngram_join.SLICE_BITS, np.int64), np.zeros(1 << ngram_join.SLICE_BITS, np.int64)
    some = [np.bincount(rng.integers(0, 1 << 16, n), minlength=1 << 16).astype(np.uint32) for n in (9_000, 1, 400_000)]
    some.append(np.zeros(1 << 16, np.uint32))
    some[-1][[0, 1, 65_535]] = 1, 2**32 - 1, 70_000
    for counts in some:
        ngram_join._add_share(total, ngram_join._share(counts))
        expected += counts
    assert (total == expected).all()
    # A task's text fills a part of the table: a place that it fills takes about a byte.
    assert len(ngram_join._share(some[0])) < 1.1 * np.count_nonzero(some[0])


def test_frequency_table_of_a_task_is_bounded(spark, monkeypatch):
    """Shares that a task hands on in pieces add up to the same table, whose size follows large texts too."""
    texts = [" ".join(f"w{i}x{j % 60}" for j in range(90)) + " a passage that all of them quote" for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(2)
    whole = ngram_join._described(docs, 20, Join())
    monkeypatch.setattr(ngram_join, "HELD_PLACES", 100)
    pieces = ngram_join._described(docs, 20, Join())
    assert pieces.filter("slice = 5").count() > whole.filter("slice = 5").count() > 0
    assert (ngram_join._frequencies(pieces, 20) == ngram_join._frequencies(whole, 20)).all()
    assert pieces.filter("slice IS NULL").count() == 40
    monkeypatch.setattr(ngram_join, "PLACE_BYTES", 1)
    assert ngram_join.table_bits(spark.range(8).selectExpr("repeat('x', 5000000) AS text")) == 26


def test_a_large_region_is_compared_some_chunks_at_a_time(spark, monkeypatch):
    """All chunks of a region against all of its blocks would be on disk at once."""
    monkeypatch.setattr(ngram_join, "BLOCK_KEYS", 4)
    monkeypatch.setattr(ngram_join, "FACING", 1)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = [rng.sample(words, 60) for _ in range(20)]
    texts += [[*t[:-1], "end"] for t in texts]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = {i: found.view(np.int64).tolist() for i, found in enumerate(ngram_join.shingle_sets([t.encode() for _, t in rows], 5))}
    held = [(1, k % 5, 5, k, s) for k, s in sets.items()]
    sets = stage(spark.createDataFrame(held, "region long, block long, blocks long, key long, shingles array<long>"), "sets")
    outside = stage(sets.filter("key >= 20"), "outside")
    found = ngram_join._against(outside, sets, Join())
    assert len(found) == 5
    links = {(r["a"], r["b"]) for df in found for r in df.collect()}
    assert {(k, k - 20) for k in range(20, 40)} == {x for x in links if x[0] != x[1]}
