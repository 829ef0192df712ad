import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, n int, key string, size string, node string, copies int, `odd.name` string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and names that operators use themselves."""
    long = "lorem ipsum dolor " * 40_000
    prose = "The river runs past the old mill and the people of the town walk along it every day in spring. " * 8
    rows = [(1, prose, "en", "a"), (2, "", "en", "b"), (3, None, None, None), (None, prose, "en", "a"), (4, long, "xx", "b"), (5, "42 !! 77", "en", None), (1, prose, "en", "a"), (6, "Grüße 字 😀\n\n\tx", "de", "a"), (7, prose + "x", None, "c")]
    return spark.createDataFrame([(*r, 1, "p", 2, "k", "s", "node", 9, "o") for r in rows], COLUMNS)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
