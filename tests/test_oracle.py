"""Every registered query against its SQL, over whole tables."""

import compare
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    with compare.connect(SF_DIR) as opened:
        yield opened


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
