import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, extra string"

WORDS = "the river ran over stones while grey birds called from reeds and children threw bread across cold water near".split()


def prose(seed, n):
    """n words, different for different seeds."""
    return " ".join(f"{WORDS[(seed * 7 + k * (seed % 5 + 1)) % len(WORDS)]}{(seed * 31 + k * k) % 97}" for k in range(n))


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text and a very long word."""
    rows = [
        (1, prose(1, 80), "en", "a", 1, "x"),
        (2, prose(1, 80), "en", "a", 1, "x"),
        (2, prose(1, 80), "en", "a", 1, "x"),
        (3, None, None, None, None, None),
        (4, "", "en", "a", 0, "x"),
        (5, " \n\t ", "de", "b", 4, "x"),
        (None, prose(6, 60), "en", None, 1, None),
        (None, None, None, None, None, None),
        (7, prose(7, 30_000), "en", "a", 1, "x"),
        (8, "x" * 200_000 + " 1 2 3 4 5 6 7 8 9 " * 2_000, "en", "a", 1, "x"),
        (9, "naïve Ünïcode 🙂 text\x00with\x7fodd characters ﬁ Å", "fr", "b", 1, "x"),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
