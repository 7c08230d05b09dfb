from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

import corpus_pipeline  # noqa: F401  the pipeline belongs to this subpackage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "same text of a few words here"),
    (6, "same text of a few words here"), (6, "same text of a few words here"), (7, LONG),
    (8, "é ü ñ ß 漢字 \U0001f600 <|endoftext|> ▁ x  y\n\nz"), (None, "no id"), (9, "\x00\x1c\x85  q"),
]


@pytest.fixture(scope="session")
def documents(spark):
    """Rows as a documents table; columns besides doc_id and text are optional."""

    def make(rows: list, extra: str = "") -> DataFrame:
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", *([extra] if extra else []))

    return make


@pytest.fixture(scope="session")
def edges(documents):
    """Nulls, empty, long and repeated texts, beside a column whose name is used inside."""
    return documents(EDGES, "'own' as n_words")
