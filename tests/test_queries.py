"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tidewatch.checks.oracle import ORACLE
from tidewatch.checks.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert differences(frame, connection, contract.oracle_sql()[name]) == []


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["Date", "mentions", "engagement"]
    assert frame.count() > 0


@pytest.mark.parametrize("name, column", [
    ("serve_top_authors_first_hours", "author"), ("panel_top_authors_first_hours", "Author"), ("serve_top_authors_by_platform", "author"),
    ("document_url_keywords", "Keywords"), ("hashtags_from_tagged_documents", "hashtags"), ("events_routed", "reason"),
    ("serve_geo_days_in_range", "SOURCEURL"),
])
def test_sparse_results_are_not_empty(spark, name, column):
    values = [r[column] for r in contract.queries()[name](spark, FOLDER).collect()]
    assert sum(bool(v) for v in values) >= 3
