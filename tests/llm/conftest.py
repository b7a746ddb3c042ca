from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, score string, row long, token long, key string"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use."""

    def build(*rows):
        full = [(i, t, "en", "s", "clash", 7, 7, "clash") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build
