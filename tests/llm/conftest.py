import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, fp string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeats, clashing extra columns."""
    long = " ".join(f"word{i % 977} the" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0, "x", "y"),
        (2, "", "en", None, 0, None, None),
        (3, "One two three.\nFour five six seven", None, "a", 3, "x", "y"),
        (4, "One two three.\nFour five six seven", "en", "b", 3, "x", "y"),
        (5, long, "en", "b", None, "x", "y"),
        (6, "   \n\t ", "de", "b", 1, "x", "y"),
        (7, "émile ΣΑΣ ½ İx   y", "fr", "c", 1, "x", "y"),
        (8, "one TWO three.\nfour five six seven", "en", "b", 3, "x", "y"),
        (9, "x", "en", "b", 3, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
