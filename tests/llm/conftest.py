"""Small documents with the awkward cases every operator must survive."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        schema = T.StructType(DOCS.fields + [T.StructField(n, T.StringType()) for n in extra])
        full = [
            (i, t, "en", s, None if t is None else len(t), *["x"] * len(extra)) for i, t, s in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


_AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog", "a"),
    (2, "", "a"),
    (3, None, "b"),
    (4, " \t\n\x0b\x0c\r ", None),
    (5, "The Quick brown fox jumps over the lazy dog", "b"),
    (5, "The Quick brown fox jumps over the lazy dog", "b"),
    (None, "no identifier here", "c"),
    (7, "mot insécable É école   x", None),
    (8, "w" * 70_000 + " " + "long " * 30_000, "a"),
]


@pytest.fixture(scope="session")
def awkward():
    return list(_AWKWARD)
