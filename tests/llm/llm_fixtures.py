"""Fixtures of these tests; imported by name, so that there is one conftest only."""

import pytest

EDGE = [
    (1, "one two three four five six seven", "x"),
    (1, "one two three four five six seven", "x"),
    (None, "a text without an id", None),
    (2, None, "y"),
    (3, "", "y"),
    (4, "  \n\t ", "y"),
    (5, "word " * 30_000, "z"),
    (6, "ünï çödé 漢字 😀 \x00 end", "z"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, repeated rows, blanks, a long text; further columns with the names operators use."""
    rows = [(i, t, "en", s, len(t or ""), 7, "node", 1.5) for i, t, s in EDGE]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, node int,"
        " band string, score double",
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
