from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builder of documents from (id, text) pairs, with the columns of the table and two that clash with those of results."""
    def build(*rows, lang="en"):
        data = [(i, t, lang, "s", None if t is None else len(t), "own", 7) for i, t in rows]
        return spark.createDataFrame(data, f"{DOCUMENTS}, score string, spans int")

    return build


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
