import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def session(spark):
    from souk.llm.common import prepare_session

    prepare_session(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with extra columns of clashing names."""

    def make(rows, extra=True):
        full = [(i, t, "en", None if k % 3 else "src0", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'x' as n_words", "1 as size", "'y' as label", "0 as node") if extra else df

    return make
