import pytest

from ledgerloom.llm.common import prepare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture
def sf_dir():
    return SF_DIR


def documents(spark, rows):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""
    table = [(i, t, "x", 1.5, None, "i", b"d", 7, [1], "m") for i, t in rows]
    return spark.createDataFrame(
        table,
        "doc_id long, text string, label string, score double, n int, _id string, "
        "_digest binary, fp long, matches array<int>, quality_score string",
    )


@pytest.fixture
def make(llm):
    return lambda rows: documents(llm, rows)
