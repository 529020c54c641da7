from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Further columns whose names operators might use themselves.
CLASHING = ("key", "spans", "fp", "hash", "words", "pos", "score", "place", "best", "stratum", "part", "value", "digest", "u", "v", "node")

TEXTS = [
    None,
    "",
    " \t\n ",
    "12 34 !?",
    "é" * 3,
    "one two three four five six seven eight nine ten",
    "one two three four five six seven eight nine ten",
    "x" * 5000,
    "word " * 3000,
    "mail me: a.b+c@ex-ample.org, call +1 (555) 010-9999 or 4111 1111 1111 1111 at 10.0.0.255.",
    "İstanbul Σίσυφος ΑΣ ﬁn <|endoftext|> don't we'll 'twas!'s \x1c\x85end ",
    "\U0001f600 漢字 ไทย",
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(c, T.StringType()) for c in CLASHING])
    extra = tuple("x" for _ in CLASHING)
    rows = [(i, t, None if i % 3 else "en", None, None if t is None else len(t), *extra) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here at all", "en", "s", 17, *extra), (None, None, None, None, None, *[None] * len(CLASHING))]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(messy):
    return messy.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
