import pytest

from starloom.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return table(spark, SF, "labels").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty, blank-only and very long texts, null ids, languages and sources, repeated
    rows, and extra columns named like the operators' own results."""
    long = "Some words, repeated often. " * 6000 + "x" * 20_000
    prose = "Rivers carry sand and silt down to the sea where tides spread it along the shore again and again."
    rows = [
        (1, prose, "en", "a", 9.0, 9, True),
        (1, prose, "en", "a", 9.0, 9, True),
        (2, None, None, None, None, None, None),
        (3, "", "en", None, 1.0, 1, False),
        (4, " \n\t ", None, "a", 1.0, 1, False),
        (5, long, "en", "a", 1.0, 1, False),
        (6, prose, "en", "b", 1.0, 1, False),
        (7, "one two three", "en", "b", 1.0, 1, False),
        (8, "ONE two three", "en", "b", 1.0, 1, False),
        (None, "no id here at all", "en", "b", 1.0, 1, False),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, n_tokens int, kept boolean")
