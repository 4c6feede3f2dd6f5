"""The byte network: gradients, training, pooling, odd texts."""

import numpy as np
import pytest
from docs import odd_rows, table
from pyspark.sql import functions as F

from quotemill.llm import language
from quotemill.llm.language import Network, Training


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = Network(["a", "b", "c"], 5, 12, 3)
    for name in Network.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    x, y = rng.integers(97, 105, (12, 7)).astype(np.uint8), rng.integers(0, 3, 7)
    grads = dict(zip(Network.NAMES, net.gradients(x, y)))

    def loss():
        return -np.log(net.probabilities(x)[:, y, np.arange(7)]).mean()

    for name in Network.NAMES:
        values = getattr(net, name)
        spots = [np.unravel_index(i, values.shape) for i in np.argsort(-np.abs(grads[name]).ravel())[:6]]
        for spot in spots:
            held = values[spot]
            values[spot] = held + 1e-3
            above = loss()
            values[spot] = held - 1e-3
            below = loss()
            values[spot] = held
            assert grads[name][spot] == pytest.approx((above - below) / 2e-3, rel=0.05, abs=2e-5)


def test_documents_pool_every_byte_once():
    net = Network(["a", "b"], 4, 8, 1)
    texts = [b"abcdefgh", b"abc", b"abcdefghijk", b"x" * 40]
    got = net.documents(texts, lanes=3)
    whole = np.frombuffer(b"abcdefgh", np.uint8)[:, None]
    assert np.allclose(got[0], net.probabilities(whole)[:, :, 0].mean(0), atol=1e-5)
    short = np.frombuffer(b"abcabcab", np.uint8)[:, None]
    assert np.allclose(got[1], net.probabilities(short)[:3, :, 0].mean(0), atol=1e-5)
    end = np.frombuffer(b"defghijk", np.uint8)[:, None]
    both = np.concatenate([net.probabilities(whole)[:, :, 0], net.probabilities(end)[5:, :, 0]])
    assert np.allclose(got[2], both.mean(0), atol=1e-5)
    assert np.allclose(got.sum(1), 1, atol=1e-4)


def bilingual(n):
    rng = np.random.default_rng(4)
    words = {"xx": "the of and thing with over".split(), "yy": "der die und über straße nicht".split()}
    rows = []
    for i in range(n):
        lang = ["xx", "yy"][i % 2]
        rows.append((i, " ".join(rng.choice(words[lang], 30)), lang if i % 7 else None, "web", 0))
    return rows


def test_learns_and_predicts(spark):
    plan = Training(docs_per_label=100, steps=60, batch=64)
    docs = table(spark, bilingual(400) + odd_rows())
    # Columns that could give it away are not read.
    learned = language.fit(docs.filter(language.remainder(F.col("doc_id")) != 0).filter("lang <> 'en'"), plan)
    assert learned.labels == ["xx", "yy"]
    got = language.predict(docs.withColumn("lang_pred", F.lit("old")), learned).collect()
    assert len(got) == 400 + len(odd_rows())
    mine = [r for r in got if r["doc_id"] is not None and r["doc_id"] > 100 and r["doc_id"] < 400]
    right = [r["lang_pred"] == ["xx", "yy"][r["doc_id"] % 2] for r in mine]
    assert np.mean(right) > 0.97
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["text"] in (None, "", "  \n\t ", "!!! ... ???"):
            assert r["lang_pred"] == "und"
    again = language.fit(docs.filter(language.remainder(F.col("doc_id")) != 0).filter("lang <> 'en'"), plan)
    assert all(np.array_equal(getattr(learned, n), getattr(again, n)) for n in Network.NAMES)
    assert language.predict(docs.limit(0), learned).count() == 0


def test_nothing_to_learn_from(spark):
    docs = table(spark, odd_rows())
    none = language.fit(docs.filter("lang IS NULL"))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in language.predict(docs, one).collect()} == {"en", "und"}


def test_sample_is_bounded(spark):
    plan = Training(docs_per_label=20, windows_per_doc=2)
    x, y, labels = language.sample(table(spark, bilingual(2000)), plan, "doc_id", "text", "lang")
    assert labels == ["xx", "yy"] and x.shape[1] == plan.window
    assert 20 <= len(x) <= 160


@pytest.mark.parametrize("key", [None, 7])
def test_sample_of_rows_that_share_a_key(spark, key):
    """Rows without an id, or with one, are drawn by their texts: neither none of them nor all."""
    rows = [(key, f"{'la casa ' if i % 2 else 'the house '}{i}", "es" if i % 2 else "en") for i in range(5_000)]
    rows += [(key, "the same row", "en")] * 3_000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    plan = language.Training(docs_per_label=200)
    x, y, labels = language.sample(df, plan, "doc_id", "text", "lang")
    assert labels == ["en", "es"] and len(x) == len(y)
    for n in (sum(y == 0), sum(y == 1)):
        assert 100 <= n <= 200 * plan.windows_per_doc
    again = language.sample(df.repartition(7), plan, "doc_id", "text", "lang")
    assert (again[0] == x).all() and (again[1] == y).all()
