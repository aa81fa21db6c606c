import pytest

SHAPE = "doc_id long, text string, source string, rid long, raw string, row string"


@pytest.fixture
def docs(spark):
    """Make documents of (id, text) pairs, with columns whose names the operators use inside."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "s", 7, "x", "y") for i, t in rows], SHAPE)

    return make
