import random

import pytest

SYLLABLES = "an the re ti on er in st ou ha ing ed le or".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    for i in range(9, n, 10):
        words[i] += ".\n" if i % 20 == 9 else "."
    return " ".join(words).replace("\n ", "\n")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(*texts_by_id, lang="en"):
    return [(i, t, lang, "src", len(t) if t is not None else None) for i, t in texts_by_id]


@pytest.fixture(scope="session")
def awkward_rows():
    """NULL ids and texts, blank and long texts, repeated rows, copies."""
    a, b, long = prose(1, 120), prose(2, 60), prose(3, 12_000)
    return rows(
        (1, a), (2, a), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, b), (7, b), (None, b + " tail"), (None, None), (8, "Éa ñ 漢字 \x1f  x"), (9, "one"), (10, prose(4, 80))
    ) + [(11, prose(5, 40), None, None, None)]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
