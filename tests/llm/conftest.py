import pytest


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def make(rows):
        frame = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id bigint, text string, row int, id string")
        return frame.repartition(3)

    return make
