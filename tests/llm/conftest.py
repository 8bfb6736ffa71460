from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _doc string, matches string, slot string"


def rows_of(texts, source=lambda i: f"s{i % 3}", lang=lambda i: "en"):
    """Documents with extra columns whose names the operators use themselves."""
    return [(i, t, lang(i), source(i), None if t is None else len(t), "x", "y", "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random words from a small vocabulary, reproducible."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgilmnoprstu") for _ in range(draw.randint(2, 8))) for _ in range(3000)]
    return lambda n, seed: " ".join(random.Random(seed).choices(words, k=n))


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in every column, empty and blank and long texts, ties and repeated rows."""
    long = prose(20_000, 77)
    rows = [
        (None, "a b c d e f", None, None, None, None, None, None),
        (None, "a b c d e f", None, None, None, None, None, None),
        (None, None, "en", "s1", 0, "x", "y", "z"),
        (1, None, None, None, None, None, None, None),
        (1, "", "en", "s1", 0, "x", "y", "z"),
        (2, " \n\n \t", "en", None, 5, "x", "y", "z"),
        (3, "!!! --- ???", "en", "s2", 11, "x", "y", "z"),
        (4, "word", "en", "s2", 4, "x", "y", "z"),
        (4, "word", "en", "s2", 4, "x", "y", "z"),
        (4, "other word", None, "s3", 4, "x", "y", "z"),
        (5, long, "en", "s2", len(long), "x", "y", "z"),
        (6, long + " end", "en", "s1", len(long) + 4, "x", "y", "z"),
        (7, "é" * 10 + " 𝒳𝒴 \u0000 ñandú\r\nÇa", "es", "s1", 20, "x", "y", "z"),
    ]
    return rows
