"""Every registered query against its SQL."""

import pytest
from compare import connect, differences

from fraudlens.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_query_matches_sql(spark, con, sf_dir, name):
    ours = catalog.QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(catalog.CHECKS[name]).df()
    assert differences(ours, theirs) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.CHECKS)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 1000
