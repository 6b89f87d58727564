from __future__ import annotations

import os

import pytest

# Python workers import the package from the repository
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]
)

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of mixed herbs under old stone bridges"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    long = " ".join(f"{w}{i}" for i in range(3000) for w in ("alpha", "beta", "gamma"))
    rows = [
        (1, PROSE, "en", "a", len(PROSE)),
        (1, PROSE, "en", "a", len(PROSE)),
        (2, PROSE.upper() + "!", "en", "a", len(PROSE) + 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 4),
        (None, PROSE, "en", None, len(PROSE)),
        (6, long, "de", "c", len(long)),
        (7, long + " tail", "de", "c", len(long) + 5),
        (8, "éß 中文。 one two", "fr", "a", 16),
        (1, "another text under the same id of document one", "en", "a", 46),
    ]
    extra = ("copy long, mix_key string, key string, n long, score double, slice int, removed_spans string, component_id long,"
             " node long, rate double, host string, x string, word string, target string")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + extra
    return spark.createDataFrame([(*r, *[None] * 14) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")
