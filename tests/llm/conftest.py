import random

import pytest

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, digest string, kept boolean, count int, text_hash bigint, gone_id bigint, tokens bigint, rate double, words string"
WORDS = [w + s for w in "stone river cloud maple amber tiger ocean violet copper meadow falcon winter".split() for s in ("", "s", "ing", "ed", "er", "ly", "ful", "ness")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, texts without letters or words."""
    long = prose(1, 30_000)
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, "hello big world"), (4, "hello big world"), (5, "hello\t\n big  world"), (None, "hello big world"), (6, long), (7, "12345 !!! 678"), (8, None), (9, long), (10, "Ünï çødé “quotes” 漢字 é"), (11, "a"), (None, None), (12, "HELLO BIG WORLD"), (13, prose(2, 400)), (14, prose(2, 400) + " tail"), (15, prose(3, 400))]
    out = []
    for i, (d, t) in enumerate(texts):
        out.append((d, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else "src0", None if t is None else len(t), None, "x", None, 1, None, 3, None, None, "w"))
    return out


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SHAPE)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
