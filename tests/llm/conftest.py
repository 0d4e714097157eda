import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Further columns that bear names the operators use themselves.
CLASH = ("row", "key", "size", "copies", "score", "fp", "digest", "target", "taken", "position", "features", "tokens", "start")


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text, lang, source)`` tuples, with columns of clashing names."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOC_SCHEMA)
        if clash:
            for name in CLASH:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
