import pytest
from cases import CLASH, EDGES


@pytest.fixture(scope="session")
def edges(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(i, t, la, s, None, *["x"] * len(CLASH)) for i, t, la, s in EDGES], schema)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
