import random

import pytest

#: Rows every operator on documents must survive: nulls, empty and blank texts, repeated rows, ties, a long text,
#: and further columns, some with the names operators use for their own.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp bigint, id string, words int, ids string"


def prose(seed: int, n: int, sep: str = " ") -> str:
    rng = random.Random(seed)
    return sep.join("".join(rng.choice("aeioustrnldm") for _ in range(rng.randint(2, 9))) for _ in range(n))


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None if text is None else len(text), 0.5, 7, "x", 3, "y")


def table(spark, rows):
    return spark.createDataFrame([row(*r) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def awkward():
    a, b = prose(1, 80), prose(2, 60)
    return [(1, a), (2, None), (3, ""), (4, "  \n\t "), (5, a), (5, a), (None, b), (6, b + " x"), (7, prose(3, 4000)),
            (8, "two words"), (9, "Ünïcödé ß 日本語 ١٢ \U0001f600 ok"), (10, "\n".join([a, b, a])), (11, "!!! ..."), (12, "A")]


@pytest.fixture
def docs(spark, awkward):
    return table(spark, awkward)


@pytest.fixture
def no_docs(spark):
    return table(spark, [])
