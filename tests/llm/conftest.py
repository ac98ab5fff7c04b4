import pytest
from pyspark.sql import functions as F

ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, "   \n\t ", "en", None),
    (4, "Hello, wörld! It's 12 o'clock.", "en", "a"),
    (4, "Hello, wörld! It's 12 o'clock.", "en", "a"),
    (None, "日本語 テキスト 𝄞 é", None, None),
    (6, "a" * 30_000 + " " + "the of and " * 9_000, "de", "b"),
    (7, "?!#*$ %% && ||", "fr", "b"),
    (8, " ".join(f"word{k}" for k in range(300)), "en", "a"),
    (9, " ".join(f"Word{k}" for k in range(300)) + "\n", "en", "a"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns named like results."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    clashing = ("row", "score", "n_words", "kept", "fingerprint", "ids", "key", "spans", "_own", "word")
    return docs.withColumns({name: F.lit(name) for name in clashing})


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 0), (4, 1), (8, 0), (9, None), (None, 1), (77, 1)]
    return spark.createDataFrame(rows, "doc_id long, toxic int")

