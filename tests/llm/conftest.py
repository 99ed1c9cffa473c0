import pytest

from playlens.llm.common import prepare


@pytest.fixture
def docs(spark):
    """Documents from texts, or (id, text) pairs, with columns whose names clash with those that operators add."""
    prepare(spark)

    def build(rows, schema="doc_id long, text string, lang string, source string, n_chars long, n string, id string, k int"):
        full = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y", 7) for i, t in full], schema)

    return build
