import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: NULLs, empty and wordless texts, repeats, ties, clashing column names and one long text.
LONG = "word " * 40_000 + "x" * 100_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
        (2, "the QUICK brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
        (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 0), (6, "one", "de", "b", 3),
        (None, "a text without an id", "en", "a", 1), (7, LONG, "fr", "c", 1), (7, LONG, "fr", "c", 1),
        (8, "é漢字 \U0001f600 don't I'LL 's  \n\n", "es", None, 1), (9, "one", "de", "b", 3),
    ]
    frame = spark.createDataFrame(rows, DOCUMENT)
    for name in ("size", "score", "n", "key", "_row", "part", "set_id", "target", "bucket", "stratum"):
        frame = frame.withColumn(name, frame.doc_id)
    return frame


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (6, None, None), (77, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
