import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _t string, _node int, kept string, text_sha256 string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like those that operators use inside."""
    rng = random.Random(7)
    long_text = prose(rng, 30_000)
    rows = [
        (1, "same text here with a few more words", "en", "src1", 5, "x", "y", 1, "k", "s"),
        (2, "same text here with a few more words", None, None, None, None, None, None, None, None),
        (2, "same text here with a few more words", "en", "src1", 5, "x", "y", 1, "k", "s"),
        (None, "same text here with a few more words", "en", "src2", 5, "x", "y", 1, "k", "s"),
        (3, None, "en", "src2", 5, "x", "y", 1, "k", "s"),
        (4, "", "de", "src1", 5, "x", "y", 1, "k", "s"),
        (None, None, None, None, None, None, None, None, None, None),
        (5, " \t\n ", "de", "src1", 5, "x", "y", 1, "k", "s"),
        (6, long_text, "de", "src3", 5, "x", "y", 1, "k", "s"),
        (7, long_text + " end", "de", "src3", 5, "x", "y", 1, "k", "s"),
        (8, "word", "de", "src3", 5, "x", "y", 1, "k", "s"),
        (9, "wörd ünïcode \U0001f600 text", "de", "src3", 5, "x", "y", 1, "k", "s"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def bare(spark):
    """Documents from (doc_id, text)."""
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
