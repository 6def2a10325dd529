import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def text(seed, n, vocabulary=400):
    return " ".join(words(seed, n, vocabulary))


@pytest.fixture
def docs(spark):
    """A documents table from texts, or from (id, text) pairs."""

    def make(texts, source="s"):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", source, None) for i, t in rows], DOCS)

    return make


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, and columns named like the operators' own."""
    rows = [(1, text(1, 80), "en", "a"), (1, text(1, 80), "en", "a"), (2, None, None, None), (None, text(2, 60), "de", None), (3, "", "en", "b"),
            (4, " \t\n ", "en", "b"), (5, text(3, 40_000, 5_000), "en", "a"), (6, text(1, 80), "en", "a"), (None, None, None, None)]
    extra = "row struct<x:int>, m string, found string, key string, fp string, bucket string, shard string, _hash string, kept string, bitmap string, " \
            "hash string, doc string, stratum string, weight string, _copies string, n_words string, size string"
    return spark.createDataFrame([(*r, None, (1,), *["x"] * 16) for r in rows], f"{DOCS}, {extra}")
