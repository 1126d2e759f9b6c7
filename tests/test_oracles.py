"""Every registered query of the market-data operators against its SQL."""

import pytest

from tidemark.plans import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, same_as_sql):
    assert name in SQL
    same_as_sql(catalog.queries()[name], SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
