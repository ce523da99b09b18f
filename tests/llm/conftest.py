import pytest

from quire.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    """documents from (doc_id, text, lang, source)."""
    def make(rows):
        return llm.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def sf(llm):
    from quire.llm.common import table
    return lambda name: table(llm, "/root/testdata/sf0.001", name)
