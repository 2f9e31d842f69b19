from __future__ import annotations

import pytest

from loomline.llm.common import ship_package

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names the operators use inside
    "blob string, node bigint, key string, component bigint, kept string, spans string, size string, "
    "copies string, taken string, h bigint, t string, d bigint, score string, bucket string, words string"
)
EXTRA = ("x", 1, "x", 1, "x", "x", "x", "x", "x", 1, "x", 1, "x", "x", "x")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text[, lang, source]) rows, with clashing extra columns."""

    def make(rows):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = (*rest, None, None)[:2]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *EXTRA))
        return spark.createDataFrame(full, SCHEMA)

    return make
