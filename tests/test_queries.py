"""Every query of the registry against its SQL."""

import pytest

import __spark_entry__
from millrace.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(name, same_rows):
    same_rows(registry.QUERIES[name], registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_rows(name, spark, sf_dir):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
