from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter", "un") for b in ("ra", "sto", "vel", "ni") for c in ("", "n", "s", "da")]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text, lang, source) rows."""

    def table(rows):
        full = [(i, t, *rest, *(None,) * (2 - len(rest)), len(t) if t is not None else None) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return table


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(WORDS[i * i % len(WORDS)] + str(i % 97) for i in range(30_000))
    return [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, long, "en", "a"), (5, "x" * 50_000, "fr", None), (6, "one two", "en", "b"), (6, "one two", "en", "b"), (7, "one two", "en", "b"), (None, "three four five", "fr", "b"), (8, "漢字 \U0001f600 café", None, "c"), (9, "12 34", "en", "c")]
