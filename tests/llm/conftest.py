import os
import random
import string

import pytest

# Workers import the package from here as well as from the archive that jobs ship.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)

# Columns after the first five clash with names that operators use or return.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, score int, id string, `row` int, "
    "word string, n_tokens string, size string, hash int, __text string, bucket int, key int, "
    "__key int, __number int, __copy int, __id int, __hash int, __times int, component long, part long, times int"
)
EXTRA = ("x", 1, "i", 2, "w", "n", "s", 3, "t", 4, 5, *range(6, 15))


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source) rows, with clashing extra columns."""

    def make(rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULL in every column, empty and blank texts, a very long one, repeated rows and copies."""
    random.seed(11)
    words = ["".join(random.choices(string.ascii_lowercase, k=random.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(random.choices(words, k=n))
    long = prose(60_000)
    same = prose(120) + ".\nÜber, école!\t日本 語　x"
    rows = [
        (None, prose(50), "en", "a"), (1, None, "en", "a"), (2, "", None, "b"), (3, " \n\t ", "de", None), (4, long, "en", "b"),
        (5, same, "en", "a"), (5, same, "en", "a"), (6, same, None, None), (7, same.upper(), "de", "c"), (8, "word", "en", "a"),
        (9, "a" * 5_000, "en", "c"), (10, "12 34 !!", "en", "a"), (11, "x  y\r\n\r\nz <|endoftext|>!", "en", "b"), (12, None, None, None),
        (13, (prose(30) + "\n") * 6, "de", "c"), (14, "İstanbul ǅ ﬁ \U0001f642‍", "de", "a"),
    ]
    return rows + [(20 + i, prose(40 + i), ["en", "de"][i % 2], "abc"[i % 3]) for i in range(40)]
