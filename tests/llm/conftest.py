import pytest

from tests.conftest import SF

LONG = "the of and in " * 20000

# NULLs in every column, empty and long texts, ties, repeated rows.
ODD_DOCS = [
    (None, None, None, None, None),
    (1, None, "en", "src0", 0),
    (2, "", "en", None, 0),
    (3, "   \n \n", None, "src1", 6),
    (4, LONG, "en", "src0", len(LONG)),
    (5, "The same words stand here. And they stand here again, word for word, for all to read.", "en", "src0", 1),
    (5, "The same words stand here. And they stand here again, word for word, for all to read.", "en", "src0", 1),
    (6, "The same words stand here. And they stand here again, word for word, for all to read.", "en", "src0", 1),
    (None, "one two", "xx", "a.example.de", 7),
    (2**60 + 1, "an id that a float can't hold, next to rows without an id", "en", "src0", 5),
    (7, "1234 5678 %%% 99", "de", "b.example.de", 16),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns whose names clash with what the operators use inside.
CLASHES = ["key", "id", "size", "node", "label", "lines", "dropped", "items", "contaminated", "language", "__key", "batch",
           "row", "bin", "problem", "e", "p", "best", "removed", "sentences", "chunk", "stack", "kind", "slot", "shard"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    from pyspark.sql import functions as F
    return odd_docs.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
