import pytest

#: Null, empty, blank, tied, repeated and very long texts.
ODD = [(None, 1), ("", 2), (" \n ", 3), ("one", 4), ("one", 4), ("same text here", 5), ("same text here", 6), ("word " * 20_000, 7)]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, null ids and columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", 0, 1, "x") for t, i in ODD] + [(None, "no id", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, class string")


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
