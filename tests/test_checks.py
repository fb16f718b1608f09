"""Every registered query against its SQL check on the smallest tables."""

import pytest
from check import compare, connect
from conftest import SMALL

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in CHECKS:
        assert compare(spark, con, SMALL, QUERIES[name], CHECKS[name]) is None
    else:
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["nombre_conductor", "recaudacion"] and df.count() > 0
