import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, bad string, dg string, t string, h string, grp long, row long, spans string, key long, doc long"


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text, source) rows as documents with more columns, whose names
    are also used inside the operators."""

    def make(rows):
        full = [(i, t, "en", s, len(t) if t else None, "x", "x", "x", "x", "x", 1, 1, "x", 1, 1) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = "alpha beta gamma. " * 6000
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "   \n\t ", None),
    (4, "one", "a"),
    (5, LONG, "b"),
    (6, "Same text here twice over", "b"),
    (6, "Same text here twice over", "b"),
    (7, "Same text here twice over", None),
    (8, "Grüße aus Köln, 中文 text\r\nline　two​! <|endoftext|> password: hunter2hunter2", "b"),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)
