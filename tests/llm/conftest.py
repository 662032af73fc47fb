import pytest

from parcelpulse.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    """Rows with a null id, a null text, repeats and columns whose names clash with results."""

    def make(rows):
        full = [(i, t, "x", i, 7, "k") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, n_tokens long, start int, key string")

    return make
