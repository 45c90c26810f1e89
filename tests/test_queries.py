"""Every named query against the SQL that computes its result from the input tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from docpipe.plans.catalogue import QUERIES
from docpipe.plans.expected import EXPECTED

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.database(sf_dir)


def test_every_query_has_expected_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert EXPECTED.items() <= entry_points.oracle_sql().items()
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns, rows = compare.sql_rows(con, EXPECTED[name])
    assert compare.normal(*compare.spark_rows(df)) == compare.normal(columns, rows)
    described = con.execute(f"DESCRIBE {EXPECTED[name]}").fetchall()
    assert {n: TYPES[t] for n, t in df.dtypes} == {r[0]: r[1] for r in described}


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


def test_no_document_is_lost_unnoticed(spark, sf_dir):
    """Documents in = flattened + without lines + failed."""
    outcome = {r.outcome: r.documents for r in QUERIES["error_summary"](spark, sf_dir).collect()}
    documents = QUERIES["bronze_receipts"](spark, sf_dir).count()
    in_gold = QUERIES["gold_flatten_variant"](spark, sf_dir).select("doc_id").distinct().count()
    assert in_gold == outcome["flattened"]
    assert sum(outcome.values()) == documents
