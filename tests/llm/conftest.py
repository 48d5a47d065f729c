import pytest


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """``make_docs([(id, text), ...], extra=...)`` with the columns of ``documents``."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], DOCS
        )

    return make
