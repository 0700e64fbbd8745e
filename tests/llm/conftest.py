from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)


@pytest.fixture(scope="session")
def corpus(spark):
    """All documents of the smallest table."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long one, copies, and repeated rows."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdeé ß中"[:9]) for _ in range(draw.randint(1, 7))).strip() or "x" for _ in range(60)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared = text(30)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, text(20000)), (6, shared), (7, shared), (8, f"{text(9)}\n{shared}\r\n{text(5)}")]
    rows += [(9, text(40) + "\n" + "a line that comes back everywhere, here too"), (10, "  A LINE that comes back everywhere, here too\t\n" + text(12))]
    rows += [(11, "a line that comes back everywhere, here too"), (12, shared + " " + text(3)), (12, shared + " " + text(3)), (13, text(300))]
    return rows + [(14, rows[-1][1]), (14, rows[-1][1])]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, [*odd_rows, (None, "a row without an id, of a few words")])


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
