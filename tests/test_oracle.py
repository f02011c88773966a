"""Every registered query against its SQL twin."""

import pytest

from tests import oracle
from tidewire import catalog

QUERIES, SQL = catalog.all_queries(), catalog.all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    twin_names, twin_rows = oracle.duck_rows(con, SQL[name])
    assert names == twin_names
    assert oracle.differences(rows, twin_rows) == []
    assert rows, "an empty result proves nothing"


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    # Operators that SQL can't express are registered without a twin.
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
