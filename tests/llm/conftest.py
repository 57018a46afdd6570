import os

import pytest

# Spark's Python workers import the library, too
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: names that operators use inside, and others that differ in case only
CLASHING = "key string, mark string, drop int, fp string, id int, root int, Hash string, kept int"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang[, source]]) to a table with the columns of documents."""

    def make(rows):
        full = [
            (r[0], r[1], *(list(r[2:]) + [None] * (4 - len(r))), len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def odd_documents(spark):
    """Null and empty cells, repeated rows, a long text, odd characters, clashing column names."""
    texts = [
        (1, "plain words in a short text", "en", "a"),
        (1, "plain words in a short text", "en", "a"),
        (1, "another text of the same id", "en", None),
        (None, "a text without an id", None, "b"),
        (None, None, None, None),
        (2, None, "en", "b"),
        (3, "", "fr", "c"),
        (4, " \n\t\r\x0b\x0c \n", "fr", "c"),
        (5, "été 日本 \U0001f600 İΣσς á  x y \x1cz\x85 \x00", "fr", "d"),
        (6, "word " * 30_000, "en", "d"),
        (7, "x" * 5_000, "en", "e"),
        (8, "line one is long enough to count\n" * 50, "en", "e"),
    ]
    rows = [(*t, len(t[1] or ""), "k", "m", 1, "f", 2, 3, "h", 4) for t in texts]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, {CLASHING}")


@pytest.fixture
def empty_documents(odd_documents):
    return odd_documents.limit(0)
