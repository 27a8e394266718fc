import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) tuples, with a column that clashes with inner names."""
    def of(rows, clash=True):
        df = spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], DOCS)
        if clash:
            for name in ("spans", "score", "hash", "block", "shards", "node", "digest", "text2"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return of


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty, blank and very long texts, repeated rows."""
    long_text = " ".join(f"word{i % 977} of" for i in range(40_000))
    return make([(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (None, "no id at all here", "en", None),
                 (4, long_text, "en", "b"), (5, "one", "de", "b"), (6, "dos palabras", "es", "c"), (6, "dos palabras", "es", "c"),
                 (7, "é😀 \x00 \x1f\xa0", "fr", "c"), (8, "the same text as nine has", "en", "a"), (9, "the same text as nine has", "en", "a")])


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
