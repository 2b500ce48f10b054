import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Nulls in any column, empty and blank texts, repeated rows, and columns named like results.
ODD = DOCS + ", ids string, n_tokens string, spans string, _id string, n_words string, epoch string, component string, toxicity string"


@pytest.fixture
def odd(spark):
    texts = [None, "", " \n\t ", "a", "one two", "x " * 30_000, "é日本\U0001F600 ﬁ", "a\nb\nc\n" * 40, "a\nb\nc\n" * 40]
    rows = [(i, t, "en", "s", 0) + ("c",) * 8 for i, t in enumerate(texts)]
    rows += [rows[7], (None, "no id", None, None, None) + (None,) * 8, (None, None, None, None, None) + (None,) * 8]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], ODD)
