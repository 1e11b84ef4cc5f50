import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Rows every operator has to bear: NULLs anywhere, empty and blank texts, very long ones, repeated rows, odd characters.
ODD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \t\n ", "en", "a", 3),
    (None, "words without a document id " * 12, "en", "a", 1),
    (4, "one", "de", "b", 3),
    (5, "same row twice " * 30, "en", "b", 9),
    (5, "same row twice " * 30, "en", "b", 9),
    (6, "12345 67890 !!! ???", "en", "b", 9),
    (7, "long " + " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000)), "en", "a", 9),
    (8, "emoji 😀 and \x85 nbsp inside ퟿ " * 20, "fr", "c", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with what operators add."""
    clash = "kept boolean, verdict string, language string, licenses string, toxicity string, fp long, row_tag long, size long, part long"
    rows = [(*r, True, "v", "l", "x", "t", 1, 2, 3, 4) for r in ODD]
    return spark.createDataFrame(rows, f"{DOCS}, {clash}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
