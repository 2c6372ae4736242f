import pytest

#: Columns that clash with names that operators use inside.
EXTRA = ("n_words", "node", "seed", "line", "words", "fp", "root", "blob", "host", "kept", "h1", "place", "vslot", "size", "u", "v", "leaf", "ids", "at")


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, ties, repeated rows, and clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "the cat sat on the mat and looked at the dog in the yard", "en"), (1, "the cat sat on the mat and looked at the dog in the yard", "en"), (1, "another text with this id", "en"), (2, None, "en"), (3, "", None), (4, " \t\n \x0b", "xx"), (None, "the cat sat on the mat and looked at the dog in the yard", "fr"), (None, None, None), (5, long, "en"), (6, long, "de"), (7, "é😀 ß\x00 ﬁ", "de")]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
