"""Every registered query against its SQL, at the smallest scale."""

import pytest

from tests.compare import connect, difference, duck_rows, spark_rows
from tests.conftest import SMALL
from verdance.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_equals_sql(spark, duck, name):
    query = QUERIES[name]
    result = query(spark, SMALL)
    columns, want = duck_rows(duck, query.oracle())
    assert sorted(result.columns) == sorted(columns)
    assert difference(spark_rows(result), want) is None


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_has_sql():
    assert all(q.sql for q in QUERIES.values())


def test_listing(spark):
    """Listing reads no table's rows, so it is no query."""
    from verdance.sources.files import list_files, size_totals

    files = list_files(spark, SMALL, "*.parquet")
    assert size_totals(files).first().files == files.count() == 14
