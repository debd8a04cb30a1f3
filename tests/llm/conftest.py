import pytest
from pyspark.sql import types as T


@pytest.fixture
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, base, "en", "a", 60), (2, base, "en", "a", 60), (2, base, "en", "a", 60), (3, base + "  \n", "en", "b", 63),
        (4, None, None, None, None), (5, "", "en", None, 0), (6, " \t\n", "en", "b", 3), (None, "lonely text", "en", "c", 11),
        (7, "x" * 30_000 + " " + "it's " * 20_000, "de", "c", 130_000), (8, base + " thirteen", "en", "b", 70), (9, "one", "en", "a", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, digest string, kept boolean"
    return spark.createDataFrame([r + (1, 0.5, "d", True) for r in rows], schema)


@pytest.fixture
def no_docs(docs):
    return docs.filter("1 = 0")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
