import pytest

from rows import AWKWARD, CLASHING, DOCUMENTS


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from rows, with clashing further columns if asked for."""
    def table(rows, clashing=False):
        df = spark.createDataFrame(rows, DOCUMENTS)
        if clashing:
            df = df.withColumns({name: df["doc_id"].cast("string") for name in CLASHING})
        return df
    return table


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD, clashing=True)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([], clashing=True)
