import random

import pytest

from tabprep.llm.staging import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows that every operator must take: nulls, empty, blank, tiny, repeated and very long texts, one id twice.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "a text without any id at all here"),
    (6, "x" * 150_000), (7, "word other " * 20_000), (8, "Ünï cödé ß 漢字 ÀÉ"), (8, "the same id with another text"), (9, "%%%%"),
]


@pytest.fixture
def frame(spark):
    ship(spark)

    def make(rows, schema=SCHEMA):
        if schema is SCHEMA:
            rows = [(i, t, None, None, None) for i, t in rows]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def prose():
    def make(seed, docs, least=5, most=60, words=400):
        r = random.Random(seed)
        vocabulary = ["".join(r.choice("abcdeéßo") for _ in range(r.randint(1, 7))) for _ in range(words)]
        return [" ".join(r.choice(vocabulary) for _ in range(r.randint(least, most))) for _ in range(docs)]

    return make
