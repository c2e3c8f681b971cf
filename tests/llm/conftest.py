from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: doc_id, text, source: nulls, empty and blank texts, ties, equal texts but for case, repeated rows, a long text and other scripts.
ODD = [
    (1, "The cat sat on the mat and slept all day long", "a"),
    (2, "THE CAT sat on the mat and slept all day long", "a"),
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n ", "b"),
    (6, "one two three", "b"),
    (7, "ONE two three", None),
    (8, "É Straße ÉTÉ", "c"),
    (9, "é straße été", "c"),
    (10, "word", "a"),
    (11, "long " * 60_000, "a"),
    (11, "long " * 60_000, "a"),
    (12, "x" * 700_000, "b"),
    (None, "no id here at all", "b"),
    (None, None, None),
    (13, "tab\x0bvertical\x0cfeed\x1cnot a blank", "d"),
    (14, "<|endoftext|> Don't <|startoftext|>", "d"),
]


def make_docs(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    return make_docs(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return make_docs(spark, [])


def corpus(n: int = 240, seed: int = 3) -> list[tuple[int, str, str]]:
    """Texts with exact and near copies, of a hot source and some small ones."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    texts: list[str] = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.15:
            texts.append(r.choice(texts))
        elif texts and kind < 0.5:
            words = r.choice(texts).split()
            for _ in range(r.randrange(1, 4)):
                words[r.randrange(len(words))] = r.choice(vocab)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(r.choices(vocab, k=r.choice([3, 12, 60, 150]))))
    return [(k, t, "hot" if r.random() < 0.5 else f"s{r.randrange(5)}") for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return make_docs(spark, rows).repartition(7)
