"""Every query with an SQL form agrees with it on the smallest tables."""

import pytest
from compare import connect, difference

from fundloom.catalog import all_oracles, all_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_agrees_with_sql(spark, con, sf_dir, name):
    got = all_queries()[name](spark, sf_dir).toPandas()
    assert difference(got, con.execute(all_oracles()[name]).df(), exact=False) is None


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_oracles())))
def test_runs_without_sql(spark, sf_dir, name):
    assert all_queries()[name](spark, sf_dir).count() > 0


def test_registry_is_consistent():
    assert set(all_oracles()) <= set(all_queries())
    # the corpus pipeline and the numbered operators are added by the entry point alone
    assert not [n for n in all_queries() if n == "pipeline" or (n.startswith("op") and n[2:3].isdigit())]
