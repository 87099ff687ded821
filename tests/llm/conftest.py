import random

import pytest

LONG = 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated
    rows, and extra columns whose names clash with the operators' own."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    a, b = text(120), text(200)
    near = b.split(" ")
    near[50] = "changed"
    rows = [
        (1, a, "en", "s1"), (2, a, None, None), (3, a.replace(" ", "\n"), "fr", "s2"), (3, a, "fr", "s2"),
        (3, a, "fr", "s2"), (None, a, "en", "s1"), (5, b, "en", "s1"), (6, " ".join(near), "en", "s1"),
        (7, "", "en", "s1"), (8, None, "en", "s1"), (9, " \t\n ", "en", ""), (10, "one two", "de", "s2"),
        (11, "One  TWO", "de", "s2"), (12, text(LONG), "en", "é"), (13, "x" * 200_000, None, "s1"),
        (14, "4111 1111 1111 1111 é <|endoftext|> 2024-02-29 a@b.org", "es", "s2"),
        (15, "die idiot clown!! " * 40, "en", "s1"), (None, None, None, None)]
    cols = "doc_id long, text string, lang string, source string, n long, row int, ids string, size string"
    return spark.createDataFrame([(*r, 1, 2, "x", None) for r in rows], cols).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame(
        [(k, k % 2, None if k == 5 else k % 3 == 0 and 1 or 0) for k in range(16)] + [(None, 1, 1), (3, 1, 0)],
        "doc_id long, quality int, toxic int")
