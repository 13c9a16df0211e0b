"""Small documents with every odd shape that the operators must take."""

from __future__ import annotations

import random

import pytest

ODD = [None, "", " \t\n ", "x", "UPPER lower", "été 你好 Ж", "a b　c", "#*$ %&| <>", "1 22 333", "...,,,"]


@pytest.fixture(scope="session")
def documents(spark):
    """300 documents: invented words, exact and near copies, shared passages, odd shapes, repeated rows, null ids."""
    rng = random.Random(11)
    words = ["".join(rng.choice(["an", "the", "or", "ti", "e", "ü"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 30, 120, 500]))) for _ in range(60)]
    rows = []
    for i in range(280):
        t = rng.choice(base)
        if rng.random() < 0.4:
            w = t.split()
            w[rng.randrange(len(w))] = "Edit%d" % i
            t = " ".join(w)
        if rng.random() < 0.2:
            t = f"{t}\n{passage}\n{' '.join(rng.choice(words) for _ in range(20))}"
        rows.append((i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2"])))
    rows += [(300 + i, t, "en", "s1") for i, t in enumerate(ODD)]
    rows += [rows[5], rows[5], (None, rows[7][1], None, None), (None, "lonely words without an id", None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string")
    # Columns that are not asked for, with names that an operator might use itself.
    return df.selectExpr("*", "cast(length(text) as bigint) as n_chars", "1 as score", "'x' as chunk", "2 as piece", "3 as _text")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < -1")
