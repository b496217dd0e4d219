import pytest

import __spark_entry__ as entry
from biblioforge.plans import queries as reference
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(reference.ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert differences(spark, sf, reference.QUERIES[name], reference.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(reference.QUERIES) - set(reference.ORACLES)))
def test_query_runs(spark, sf, name):
    assert reference.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
