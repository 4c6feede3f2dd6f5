"""Mixing, sharding, licence scans and chat formatting against plain Python."""

import hashlib
import os
import re
from collections import Counter

import pytest
from docs import odd_rows, table
from pyspark.sql import functions as F

from quotemill.llm import chats, licences, mixing, sharding
from quotemill.llm.licence_texts import KNOWN

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(5, 2, 1), budget=1.5, cap=2.0) -> dict:
    """Reshares what is over until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        left = budget * sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: cap * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 17), "en", f"s{i % 7 % 5}" if i % 11 else None, 0) for i in range(3000)]
    docs = table(spark, rows)
    got = mixing.decide(docs).select("row.doc_id", "row.text", "row.source", "copies", "source_size", "target").collect()
    assert len(got) == len(rows)
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        n = len(WORDS.findall(r["text"]))
        sizes[r["source"]] += n
        taken[r["source"]] += n * r["copies"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2
    expected = plain_targets(sizes)
    for s in sizes:
        assert targets[s] == pytest.approx(expected[s])
        assert abs(taken[s] - targets[s]) <= 17
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    again = mixing.decide(docs.repartition(5)).select("row.doc_id", "copies").collect()
    assert Counter(again) == Counter((r["doc_id"], r["copies"]) for r in got)


def test_mix_of_odd_rows(spark):
    docs = table(spark, odd_rows())
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    decided = mixing.decide(docs).select("row.*", F.col("copies").alias("n")).collect()
    assert len(decided) == len(odd_rows())
    assert got.count() == sum(r["n"] for r in decided)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_mix_joins_many_sources_by_salts(spark, monkeypatch):
    rows = [(i, "a b c", "en", f"s{i % 50}", 0) for i in range(500)]
    plain = Counter(mixing.decide(table(spark, rows)).select("row.doc_id", "copies").collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    assert Counter(mixing.decide(table(spark, rows)).select("row.doc_id", "copies").collect()) == plain


def test_lookup_table_is_even_and_stable():
    names = [f"n{i}" for i in range(10)]
    before = sharding.lookup_table(names, 10_007)
    loads = Counter(before)
    assert max(loads.values()) - min(loads.values()) <= 1
    after = sharding.lookup_table(names[:-1], 10_007)
    moved = sum(a != b for a, b in zip(before, after) if a != 9)
    assert moved < 0.05 * len(before)
    shuffled = sharding.lookup_table(names[::-1], 10_007)
    assert [9 - x for x in shuffled] == before
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 10_000)


def test_lookup_table_by_brute_force():
    """Every shard in turn takes its most preferred free slot."""
    names, size = ["b", "a", "c"], 101
    preferences = []
    for name in sorted(names):
        digest = hashlib.sha256(name.encode()).digest()
        start, step = int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:16], "big") % (size - 1) + 1
        preferences.append((names.index(name), [(start + j * step) % size for j in range(size)]))
    expected = [None] * size
    while None in expected:
        for index, slots in preferences:
            free = [s for s in slots if expected[s] is None]
            if free:
                expected[free[0]] = index
    assert sharding.lookup_table(names, size) == expected


def test_placement(spark):
    docs = table(spark, odd_rows())
    names = ["x", "y", "z"]
    got = sharding.place(docs, ["doc_id"], names, 101).collect()
    assert len(got) == len(odd_rows())
    lookup = sharding.lookup_table(names, 101)
    assert all(r["shard"] == names[lookup[r["slot"]]] for r in got)
    assert all(len({r["slot"] for r in got if r["doc_id"] == k}) == 1 for k in {r["doc_id"] for r in got})
    assert sharding.place(docs.limit(0), ["doc_id"], names, 101).count() == 0
    plan = sharding.place(docs, ["doc_id"], names, 101)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_licences(spark):
    mit = KNOWN["MIT"]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Somebody\nAll rights reserved.\n" + mit.replace("\n", " ").upper(), None, None, 0),
        (2, mit.replace("sublicense", "sub-licence").replace(",", " ;"), None, None, 0),
        (3, mit + "and more", None, None, 0),
        (4, "Some text.\r\n  RELEASED under the MIT licence!\nMore.\nReleased under the MIT License.", None, None, 0),
        (5, "Copyright 2020 x", None, None, 0),
        *odd_rows(),
    ]
    got = licences.scan(table(spark, rows), licences.known_licences(spark)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    first = next(r for r in got if r["doc_id"] == 1 and r["licence"])
    assert first["licence"] == "MIT headed"
    assert [r["licence"] for r in got if r["doc_id"] == 2 and r["licence"]] == ["MIT"]
    assert by_id[40]["licence"] is None and by_id[40]["notices"] == []
    assert [r["notices"] for r in got if r["doc_id"] == 4 and r["notices"]] == [["MIT line"]]
    empty = hashlib.sha256(b"").hexdigest()
    assert empty in {r["digest"] for r in got if r["doc_id"] == 5} and empty in {r["digest"] for r in got if r["doc_id"] is None}
    assert all(r["licence"] is None for r in got if r["doc_id"] == 3)
    assert licences.scan(table(spark, []), licences.known_licences(spark)).count() == 0
    none = licences.known_licences(spark).limit(0)
    assert {r["licence"] for r in licences.scan(table(spark, rows), none).collect()} == {None}


def test_whole_published_licences(spark):
    folder = os.path.join(os.path.dirname(licences.__file__), "licences_published")
    texts = {f.removesuffix(".txt"): open(os.path.join(folder, f), encoding="utf-8").read() for f in sorted(os.listdir(folder))}
    short = {"BSD-3-Clause": "BSD 3-Clause License", "ISC": "ISC License", "Zlib": "zlib License"}
    cases = [(name, text) for name, text in texts.items()]
    cases += [("Apache-2.0", " ".join(texts["Apache-2.0"].split("END OF TERMS")[0].split()))]
    cases += [(f"{name} headed", f"{title}\n\nCopyright (c) 2020, Jane Doe\n\n{KNOWN[name]}") for name, title in short.items()]
    cases += [("MIT", "Copyright Jane Doe\n\n" + KNOWN["MIT"].replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS"))]
    cases += [("BSD-2-Clause", KNOWN["BSD-2-Clause"].replace("above copyright", "above\ncopyright"))]
    rows = [(i, text, None, None, 0) for i, (_, text) in enumerate(cases)]
    got = {r["doc_id"]: r["licence"] for r in licences.scan(table(spark, rows), licences.known_licences(spark)).collect()}
    assert [got[i] for i in range(len(cases))] == [name for name, _ in cases]


def test_licences_of_a_table_with_empty_and_equal_texts(spark):
    known = spark.createDataFrame([("b", "X y"), ("a", "x, Y!"), ("e", "..."), (None, "z"), ("n", None)], "licence string, text string")
    assert [tuple(r) for r in licences.known_digests(known).collect()] == [(hashlib.sha256(b"x y").hexdigest(), "a")]


EVENTS = "conv_id long, seq long, event string, message long, role string, text string"


def plain_fold(events):
    """Event by event."""
    out = {}
    order = sorted(events, key=lambda e: (e[1], e[2], e[3]))
    by_conv = {}
    for e in order:
        by_conv.setdefault(e[0], []).append(e)
    for conv, log in by_conv.items():
        messages = {}
        for n, (_, _, event, message, role, text) in enumerate(log):
            if event == "message":
                m = messages.setdefault(message, {"opened": n, "role": role, "live": True})
                m["text"] = text or ""
            elif message in messages:
                m = messages[message]
                if event == "delta":
                    m["text"] += text or ""
                elif event == "edit":
                    m["text"] = text or ""
                elif event == "regenerate":
                    m["text"] = ""
                    for other in messages.values():
                        if m["opened"] < other["opened"] < n:
                            other["live"] = False
        kept = sorted((m for m in messages.values() if m["live"]), key=lambda m: m["opened"])
        out[conv] = [(m["role"] or "", m["text"]) for m in kept]
    return {c: t for c, t in out.items() if t}


def test_fold_against_event_by_event(spark):
    import random

    rng = random.Random(3)
    events, seq = [], 0
    for conv in range(30):
        for _ in range(rng.randint(1, 40)):
            seq += 1
            event = rng.choice(["message", "message", "delta", "delta", "edit", "regenerate", "other"])
            events.append((conv, seq, event, rng.randint(1, 8), rng.choice(["user", "assistant", None]), rng.choice([None, "", "a#<b", "</turn>\n### x", "\\s\\"])))
    rng.shuffle(events)
    df = spark.createDataFrame(events, EVENTS).selectExpr("*", "1 AS n", "2 AS opened", "3 AS formatted")
    read = chats.read_back(chats.format_chats(df)).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in read} == plain_fold(events)
    for r in read:
        assert r["loss_texts"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]


def test_chat_rows_of_any_kind(spark):
    hard = "\\### Assistant: </turn> ok \\h\\l\\s\\n " + "x" * 3000 + "\U0001f600é" * 700
    rows = [
        (1, 2, "assistant", hard), (1, 1, "user", None), (1, 2, "assistant", hard), (1, None, None, ""),
        (None, 0, "us\ner", "</turn>\n"), (2, 0, "assistant", None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seq", "2 AS message", "3 AS event")
    read = {r["conv_id"]: r for r in chats.read_back(chats.format_chats(chats.as_events(df))).collect()}
    assert [tuple(t) for t in read[1]["turns"]] == [("", ""), ("user", ""), ("assistant", hard), ("assistant", hard)]
    assert read[1]["loss_texts"] == [hard, hard]
    assert [tuple(t) for t in read[None]["turns"]] == [("us\ner", "</turn>\n")]
    assert read[2]["loss_texts"] == [""]
    assert chats.format_chats(chats.as_events(df.limit(0))).count() == 0


def test_native_plans_have_no_python(spark):
    docs = table(spark, odd_rows(), clash=False)
    turns = docs.selectExpr("doc_id conv_id", "doc_id turn", "lang role", "text")
    for df in (
        mixing.decide(docs),
        licences.scan(docs, licences.known_licences(spark)),
        chats.read_back(chats.format_chats(chats.as_events(turns))),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
