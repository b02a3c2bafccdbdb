import pytest
from pyspark.sql import DataFrame

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text[, source])."""

    def make(rows) -> DataFrame:
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names clash with results."""
    long_text = "\n".join(f"line {i} of a very long text, number {i * i}" for i in range(6000))
    rows = [
        (1, None, None), (2, "", "a"), (None, "no id here, but some words to read", "a"), (None, None, None), (3, " \t\n\x0b\x0c\r", "b"),
        (4, "one", "b"), (5, long_text, "a"), (6, "same words in both of these rows", "a"), (6, "same words in both of these rows", "a"),
        (7, "same words in both of these rows", "b"), (8, "ünïcödé 日本語 😀   text more", "b"),
    ]
    df = docs_of(rows)
    taken = "tokens source block order times epochs lines ends bounds left id gone held owner units copy chosen key row kept all_gone of_chunks"
    for name in (*(f"__{c}" for c in taken.split()), "a.b c", "spans", "n_words", "kept", "score", "fp", "key", "first", "words", "ids", "row", "label", "place", "epoch", "component_id"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
