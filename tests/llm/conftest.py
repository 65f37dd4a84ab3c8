import pytest


@pytest.fixture
def frame(spark):
    """Build documents rows (doc_id, text) with further columns whose names clash with the operators' own."""

    def build(rows, id_name="doc_id", text_name="text"):
        return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows],
                                     f"{id_name} long, {text_name} string, id string, __row string, group long")
    return build
