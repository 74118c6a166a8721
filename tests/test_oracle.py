"""Every registered query against its SQL counterpart, on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from rosterflow.queries import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None
