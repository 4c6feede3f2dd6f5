"""Small tables of odd documents."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as the operators name theirs.
CLASHING = ["id", "key", "row", "ids", "copies", "target", "size", "part", "slot", "shard", "score", "class", "u", "name"]


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice("alpha beta gamma delta river stone cloud Maple über été naïve 42 don't".split()) for _ in range(words))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    long = " ".join(f"w{i % 977} {sentence(rng, 1)}" for i in range(30_000))
    texts = [
        None, "", "  \n\t ", "one", "two words", "!!! ... ???", sentence(rng, 40), sentence(rng, 300), long,
        "a\x1cb\x1fc \x85 \xa0d e \U0001f600 <|endoftext|> x<|startoftext|>y İSTANBUL ΣΑΣ é ﬁ",
    ]
    rows = [(i, t, "en" if i % 2 else None, "web" if i % 3 else None, None) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (40, rows[6][1], "en", "web", 1), (None, rows[7][1], None, None, None), (None, None, None, None, None)]
    return rows


def table(spark, rows, clash: bool = True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING]) if clash else df
