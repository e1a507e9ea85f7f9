import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows with the other columns and some whose names clash with what operators use."""
    def build(rows, partitions=3):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", "y", 1.5) for i, t in rows]
        kind = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, range double"
        return spark.createDataFrame(full, kind).repartition(partitions)
    return build
