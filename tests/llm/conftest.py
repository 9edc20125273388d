import pytest

from tallyframe.llm.workers import reach_package


@pytest.fixture(autouse=True)
def workers(spark):
    reach_package(spark)


@pytest.fixture
def documents(spark):
    """documents((doc_id, text), ..) with the other columns of the table, and an extra one whose name clashes with results."""

    def make(*rows):
        full = [(k, t, "en", "src", len(t or ""), 7) for k, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score int")

    return make
