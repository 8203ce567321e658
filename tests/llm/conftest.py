import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, rep int, taken int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, and columns whose names the
    operators use themselves."""
    long = " ".join(f"word{i % 977} and the other{i % 31}." for i in range(6000))
    rows = [
        (1, "The cat sat on the mat. It was happy there.\nA dog came by.", "en", "a", 10, 0.5, "x", 1, 1),
        (1, "The cat sat on the mat. It was happy there.\nA dog came by.", "en", "a", 10, 0.5, "x", 1, 1),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, None, None, None, None),
        (4, " \n\t ", None, "b", 4, None, None, None, None),
        (5, long, "en", "b", len(long), None, None, None, None),
        (6, "12345 67890 !!!", "en", None, 15, None, None, None, None),
        (None, "A text without an id.", "en", "c", 21, None, None, None, None),
        (7, "Der Hund und die Katze sind im Haus, und das ist gut so.", "de", "a", 5, None, None, None, None),
        (8, "The cat sat on the mat. It was happy there.\nA dog came by.", "en", "b", 10, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
