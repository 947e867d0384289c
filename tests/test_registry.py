import pytest

from oracles import assert_same
from parcelforge.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
