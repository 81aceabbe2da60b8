"""Every registered query against its SQL on the smallest tables."""

import pytest

from litpulse.catalog import ORACLES, QUERIES
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    error, _ = compare(QUERIES[name](spark, sf), con, ORACLES.get(name))
    assert not error


def test_entry_file(spark, sf):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1
