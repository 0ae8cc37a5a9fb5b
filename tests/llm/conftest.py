import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs or longer rows, with a clashing extra column."""
    def build(rows, **more):
        schema = "doc_id long, text string, lang string, source string, n_chars long, `ids.x` int"
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), 7) for r in rows
        ]
        return spark.createDataFrame(full, schema)

    return build
