import pytest

from sheafworks.plans import registry

from oracle import compare

EMPTY_OK = {"page_sets_differ"}


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, name):
    assert compare(spark, name, registry.QUERIES[name], registry.ORACLES[name], "/root/testdata/sf0.001") > 0 or name in EMPTY_OK


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
