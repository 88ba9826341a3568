import random

import pytest

DOCUMENTS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    # names that operators make themselves
    " row string, _id string, _salt string, size string, shard string, slot string, score string,"
    " length string, copies string, piece string, fp string, kept string, lang_pred string"
)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text, source) rows, with clashing extra columns."""

    def make(rows):
        full = [(i, t, None, s, None, *["x"] * 13) for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def words():
    """Seeded random words."""

    def make(n, seed=0, kinds=5000):
        r = random.Random(seed)
        return [f"w{r.randrange(kinds)}" for _ in range(n)]

    return make


@pytest.fixture
def odd(words):
    """Nulls, empty and long texts, ties, repeated rows and a hot source."""
    long = " ".join(words(30_000, 1))
    rows = [(1, None, "a"), (2, "", "a"), (3, "one", None), (4, "one", "a"), (5, long, "a"), (6, long, "b")]
    rows += [(7, "two words", "a"), (7, "two words", "a"), (None, "no id", "a"), (8, " \t\n", "a")]
    rows += [(100 + i, " ".join(words(40, i % 7)), "hot") for i in range(60)]
    return rows
