import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from driftline.llm.ship import ship

    ship(spark)


def texts(spark, rows):
    """A table of documents with columns whose names the operators use themselves."""
    wide = [(i, t, "x", 1, None, "y", 2, "z", None, 0.5) for i, t in rows]
    kinds = "doc_id long, text string, words string, n int, ids string, spans string, size int, id string, keys string, score double"
    return spark.createDataFrame(wide, kinds)
